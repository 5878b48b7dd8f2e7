"""Sentences and words as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_END = r"\."
CONTROLS = "".join(map(chr, range(ord(" ") + 1)))


def trim_controls(text: Column) -> Column:
    """Strip every character up to the blank from both ends, not blanks alone."""
    return F.btrim(text, F.lit(CONTROLS))


def sentence_texts(text: Column) -> Column:
    return F.filter(F.split(text, SENTENCE_END), lambda s: F.length(s) > 0)


def sentence_words(sentence: Column) -> Column:
    """Lower-cased words of a sentence; a blank sentence gives an empty array."""
    body = F.replace(trim_controls(sentence), F.lit("'"), F.lit(" "))
    whole = F.split(F.lower(body), " ")
    # A capital sigma is the one letter whose lower case depends on those around it.
    each = F.transform(F.split(body, " "), F.lower)
    return F.array_remove(F.when(body.contains("Σ"), each).otherwise(whole), "")


def line_words(line: Column) -> Column:
    """Words of a line parted by single blanks. Inner empty words stay, trailing ones go."""
    body = F.rtrim(line)
    return F.when(F.length(body) > 0, F.split(body, " ")).otherwise(F.array().cast("array<string>"))
