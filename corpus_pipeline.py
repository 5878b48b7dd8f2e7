"""From raw documents to packed sequences: quality, near copies, repeated passages, packing.

Every stage gets what the one before kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm.jaccard_join import near_documents
from marginalia.llm.packing import packed
from marginalia.llm.ranking import keep_good
from marginalia.llm.suffix_dedup import without_repeats
from marginalia.llm.tables import numbered, table
from marginalia.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one with the smallest id.

    Documents without words are in no group and stay. Every row is a document of its own, also where
    ids repeat or are null; a row without an id comes after all others of its group.
    """
    scratch, columns = Scratch(spark), docs.columns
    if docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").isEmpty():
        keyed, key = docs, "doc_id"
    else:  # the ids do not tell the rows apart: their places in the order of the ids do
        rows = scratch.keep(docs.withColumn("_row_id", F.monotonically_increasing_id()), "rows")
        places, _ = numbered(rows.select("doc_id", "_row_id"), scratch, F.col("doc_id").asc_nulls_last(), F.col("_row_id"))
        keyed = scratch.keep(rows.join(places.select("_row_id", F.col("place").alias("_place")), "_row_id"), "keyed")
        key = "_place"
    # Keys alone are shuffled besides the documents: a dropped one is not the smallest of its group.
    found = near_documents(keyed.select(F.col(key).alias("doc_id"), "text"), scratch)
    dropped = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(key))
    return keyed.join(dropped, key, "left_anti").select(*columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 100 bytes and more that stand earlier too."""
    return without_repeats(docs, Scratch(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 1024."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: Neither the classifier nor the tokenizer can be told in SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
