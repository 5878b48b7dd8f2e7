"""Reading inputs and cutting rows evenly, for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.scratch import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names: extra columns cannot clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, scratch: Scratch, *order: Column) -> tuple[DataFrame, int]:
    """The rows with their ``place`` from 0 in the given order, and how many there are.

    The rows are ranged and sorted by Spark and written with their task and their row in it.
    What comes to the driver, and is broadcast back, is one number per task. The order should
    tell rows apart, or a hot value meets in one task.
    """
    sorted_rows = df.repartitionByRange(shuffle_width(df), *order).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id()
    tagged = sorted_rows.withColumns({"_task": F.shiftright(local, 33), "_row": local.bitwiseAND(F.lit((1 << 33) - 1))})
    written = scratch.keep(tagged, "numbered")
    counts = sorted(written.groupBy("_task").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for task, n in counts:
        starts.append((task, total))
        total += n
    before = df.sparkSession.createDataFrame(starts, "_task long, _start long")
    found = written.join(F.broadcast(before), "_task")
    return found.withColumn("place", F.col("_start") + F.col("_row")).drop("_task", "_row", "_start"), total
