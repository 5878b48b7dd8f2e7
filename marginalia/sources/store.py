"""Saving, loading and exporting pages, graphs and vector tables.

Paths are Hadoop URIs: ``hdfs://…``, ``s3a://…`` or local.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from marginalia.operators.graph import Graph
from marginalia.scratch import Scratch, shuffles_removed

PAGES = "pages"
VERTICES = "graph_vertices"
EDGES = "graph_edges"
REJECTS = "rejects"

PAGES_SCHEMA = "title string, text string, edges array<struct<src:string,dst:string>>"
VERTICES_SCHEMA = "id bigint, label string"
EDGES_SCHEMA = "src bigint, dst bigint, weight bigint"


def save_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages and go on from the written table.

    The bloom filter on the title lets a lookup by title skip row groups without any sorting.
    """
    path = f"{folder}/{PAGES}"
    with shuffles_removed(pages.sparkSession):
        (
            pages.select("title", "text", "edges")
            .write.mode("overwrite")
            .option("parquet.bloom.filter.enabled#title", "true")
            .option("compression", "zstd")
            .parquet(path)
        )
    return load_pages(pages.sparkSession, folder)


def load_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PAGES_SCHEMA).parquet(f"{folder}/{PAGES}")


def save_pages_by_title(pages: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Write the pages in buckets by title, sorted in each, and go on from the table.

    A lookup of many titles then shuffles the titles alone (``pages.find_pages``). Take at least as
    many buckets as the session shuffles into, or Spark prefers to shuffle. The buckets are known to a
    table of the session's catalog, one per folder, which ``load_pages_by_title`` makes again in a
    later session. Pages of one title share a bucket, and so do those without a title.
    """
    spark = pages.sparkSession
    path, name = _by_title(folder)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = pages.select("title", "text", "edges").repartition(buckets, "title")
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, "title").sortBy("title").saveAsTable(name)
    spark.range(1).selectExpr(f"{buckets} AS buckets").write.mode("overwrite").json(f"{path}_layout")
    return spark.table(name)


def load_pages_by_title(spark: SparkSession, folder: str) -> DataFrame:
    path, name = _by_title(folder)
    buckets = spark.read.schema("buckets int").json(f"{path}_layout").first()["buckets"]
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # of files that may have been written again since
    spark.sql(
        f"CREATE TABLE {name} ({PAGES_SCHEMA}) USING parquet "
        f"CLUSTERED BY (title) SORTED BY (title) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def _by_title(folder: str) -> tuple[str, str]:
    path = f"{folder.rstrip('/')}/{PAGES}_by_title"
    return path, f"{PAGES}_{md5(path.encode()).hexdigest()}"


def save_rejects(rejects: DataFrame, folder: str) -> DataFrame:
    """Write the ``(record)`` rows that an import could not parse."""
    rejects.select("record").write.mode("overwrite").parquet(f"{folder}/{REJECTS}")
    return load_rejects(rejects.sparkSession, folder)


def load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("record string").parquet(f"{folder}/{REJECTS}")


def save_graph(graph: Graph, folder: str) -> Graph:
    graph.vertices.select("id", "label").write.mode("overwrite").parquet(f"{folder}/{VERTICES}")
    graph.edges.select("src", "dst", "weight").write.mode("overwrite").parquet(f"{folder}/{EDGES}")
    return load_graph(graph.vertices.sparkSession, folder)


def load_graph(spark: SparkSession, folder: str) -> Graph:
    return Graph(
        spark.read.schema(VERTICES_SCHEMA).parquet(f"{folder}/{VERTICES}"),
        spark.read.schema(EDGES_SCHEMA).parquet(f"{folder}/{EDGES}"),
    )


def export_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """One JSON object per row. For a single file all tasks write their parts first, and one task then
    only copies their lines, in order, whatever ``df`` takes to work out."""
    if not single_file:
        df.write.mode("overwrite").json(path)
        return
    with Scratch(df.sparkSession) as scratch:
        parts = scratch.file("parts")
        df.write.json(parts)
        df.sparkSession.read.text(parts).coalesce(1).write.mode("overwrite").text(path)


def save_vectors(vectors: DataFrame, folder: str) -> DataFrame:
    """Write a vector table and return it as read back."""
    with shuffles_removed(vectors.sparkSession):
        vectors.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/vectors")
    return load_vectors(vectors.sparkSession, folder)


def load_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("word string, vector array<double>").parquet(f"{folder}/vectors")
