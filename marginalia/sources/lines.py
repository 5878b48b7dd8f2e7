"""Plain text files, one row per line."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from marginalia.sources.dump import spread_out


def scan_lines(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """``(value)`` per line; the reader splits large files by ``maxPartitionBytes``.

    With ``tasks`` it makes about so many splits of the files' bytes, without a shuffle. Only lines of
    files that cannot be split, as compressed ones, are dealt out over so many tasks.
    """
    if not tasks:
        return spark.read.text(path)
    lines = _split_lines(spark, path, tasks)
    few = lines._jdf.queryExecution().toRdd().getNumPartitions() < tasks / 2
    return spread_out(lines, tasks if few else None)


def _split_lines(spark: SparkSession, path: str, tasks: int) -> DataFrame:
    """The reader sizes its splits by the settings of the session that names the path, so a session
    of its own names it here, and the caller's takes the relation over by a name that goes again."""
    other, name = spark.newSession(), f"lines_{uuid4().hex}"
    other.conf.set("spark.sql.files.minPartitionNum", str(tasks))
    other.conf.set("spark.sql.files.openCostInBytes", "1")
    other.read.text(path).createGlobalTempView(name)
    try:
        return spark.table(f"global_temp.{name}")
    finally:
        other.catalog.dropGlobalTempView(name)
