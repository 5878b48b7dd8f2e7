"""Tables that a multi-step operator writes and reads back."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return folder.rstrip("/")


@contextmanager
def held_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that hold within; the session's own hold again afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Within, the files of a shuffle go once the write or answer they were for is done, and not only when
    the driver happens to collect its garbage."""
    return held_settings(spark, {SHUFFLE_CLEANUP: "true"})


class Scratch:
    """One run's own folder below the shared one; as a context manager it deletes it at the end.

    Reading back a written table cuts the lineage, survives the loss of executors and fixes
    whatever the plan before left open, such as generated ids. Every call of ``file`` or
    ``keep`` gets a fresh path, so results of earlier calls stay readable until they are
    dropped or the scratch is closed.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{uuid4().hex}"
        self._made = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def file(self, name: str) -> str:
        self._made += 1
        return f"{self.path}/{self._made:03d}_{name}"

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = self.file(name)
        df.write.options(**options).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def keep_all(self, parts: Iterable[DataFrame], name: str, **options: str) -> DataFrame:
        """As ``keep``, for the rows of several tables of one schema, written one after the other."""
        path = self.file(name)
        for df in parts:
            df.write.mode("append").options(**options).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def keep_bucketed(self, df: DataFrame, name: str, key: str, buckets: int, **options: str) -> DataFrame:
        """As ``keep``, but joins and groups by ``key`` in as many partitions need no shuffle."""
        path, table = self.file(name), f"scratch_{uuid4().hex}"
        df.write.options(path=path, **options).bucketBy(buckets, key).saveAsTable(table)
        kept = self.spark.table(table)
        kept.scratch_path, kept.scratch_table = path, table
        return kept

    def drop(self, df: DataFrame | None) -> None:
        """Delete the table that ``keep`` returned; for rounds that nothing reads any more."""
        if df is not None:
            if table := getattr(df, "scratch_table", None):
                self.spark.sql(f"DROP TABLE {table}")
            self._delete(df.scratch_path)

    def close(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
