"""Joins of a large table with a one-row-per-key table that survive hot keys."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

SALT = "_salt"
SPLITS = "_splits"


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, key: str, n: str, pieces: int) -> DataFrame | None:
    """``(key, _splits)`` for keys that hold more than one ``pieces``-th of all rows, or None.

    Fewer than ``pieces`` keys can do so, which bounds both what comes to the driver and what
    is broadcast. A key is split into parts of about one ``pieces``-th of the rows each. One
    pass over the counts finds the total along with the largest.
    """
    seen = Observation()
    largest = (
        counts.select(key, n)
        .observe(seen, F.sum(n).alias("rows"))
        .orderBy(F.desc(n))
        .limit(pieces)
        .collect()
    )
    share = (seen.get["rows"] or 0) / pieces
    hot = [(row[key], ceil(row[n] / share)) for row in largest if row[n] > share]
    if not hot:
        return None
    schema = StructType([counts.schema[key], StructField(SPLITS, IntegerType())])
    return counts.sparkSession.createDataFrame(hot, schema)


def salt_rows(rows: DataFrame, key: str, hot: DataFrame, spread: list[str]) -> DataFrame:
    """Give each row of a hot key one of the key's salts.

    The salt hashes the other columns, and the task's number so that copies of one row part
    too. A retried task finds the same salts again, which a random number would not.
    """
    salt = F.pmod(F.xxhash64(*spread, F.spark_partition_id()), F.col(SPLITS)).cast("int")
    return (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn(SALT, F.when(F.col(SPLITS).isNull(), 0).otherwise(salt))
        .drop(SPLITS)
    )


def salt_copies(lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat the row of a hot key once per salt; all others stay single."""
    last = F.coalesce(F.col(SPLITS), F.lit(1)) - 1
    return (
        lookup.join(F.broadcast(hot), key, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))
        .drop(SPLITS)
    )


def look_up(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Join ``rows`` with ``lookup`` (one row per key) on ``key``, hot keys split over tasks.

    ``counts(key, n)`` saves a counting pass where the number of rows per key is known, if
    only about: it decides what is split, not what is found.
    """
    if counts is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    hot = hot_keys(counts, key, "n", pieces or shuffle_width(rows))
    if hot is None:
        return rows.join(lookup, key, how)
    spread = [c for c in rows.columns if c != key]
    salted = salt_rows(rows, key, hot, spread)
    return salted.join(salt_copies(lookup, key, hot), [key, SALT], how).drop(SALT)
