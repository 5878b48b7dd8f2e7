"""Sentences, lines and vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.functions.tokens import line_words, sentence_texts, sentence_words

MIN_COUNT = 5


def sentences(pages: DataFrame) -> DataFrame:
    """``(tokens)`` per sentence of ``text``."""
    parts = pages.select(F.explode(sentence_texts(F.col("text"))).alias("sentence"))
    return parts.select(sentence_words(F.col("sentence")).alias("tokens"))


def line_tokens(lines: DataFrame) -> DataFrame:
    """``(tokens)`` per line of ``value`` that is not empty."""
    return lines.filter(F.length("value") > 0).select(line_words(F.col("value")).alias("tokens"))


def words(corpus: DataFrame) -> DataFrame:
    """``(word)`` per token. Before a plain ``explode`` Spark would look for rows without tokens, and
    for that split every sentence once more."""
    placed = corpus.select(F.posexplode_outer("tokens").alias("place", "word"))
    return placed.filter("place is not null").select("word")


def corpus_words(corpus: DataFrame) -> DataFrame:
    return words(corpus).distinct()


def vocabulary_counts(corpus: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    counts = words(corpus).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)
