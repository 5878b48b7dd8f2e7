"""Link graphs and property graphs as a table of vertices and a table of edges.

A graph is directed, and parallel edges are kept.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.operators.skew import look_up
from marginalia.scratch import Scratch


class Graph(NamedTuple):
    """``vertices(id, …)`` and ``edges(src, dst, …)``; link graphs carry a ``label`` per
    vertex and a ``weight`` of 1 per edge."""

    vertices: DataFrame
    edges: DataFrame


def edge_ends(edges: DataFrame, name: str) -> DataFrame:
    """Both ends of every edge in one column, from one scan."""
    return edges.select(F.explode(F.array("src", "dst")).alias(name))


def graph_labels(links: DataFrame) -> DataFrame:
    """``(label, ends)``: each distinct name with the number of link ends it takes."""
    return edge_ends(links, "label").groupBy("label").agg(F.count("*").alias("ends"))


def name_vertices(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, label, ends)``. The ids are unique but not dense, and only fixed once written.

    They rise with the label: names that are alike, such as those of one site, mostly link to each
    other, so that a range of ids holds more edges than a random set of vertices does.
    """
    labels = scratch.keep(graph_labels(links), "labels")  # ranging it reads it twice
    ordered = labels.repartitionByRange("label").sortWithinPartitions("label")
    return scratch.keep(ordered.select(F.monotonically_increasing_id().alias("id"), "label", "ends"), "names")


def encode_edges(links: DataFrame, names: DataFrame) -> DataFrame:
    """Replace the names in ``links(src, dst)`` by vertex ids."""

    def encode(rows: DataFrame, end: str) -> DataFrame:
        ids = names.select(F.col("label").alias(end), F.col("id").alias(f"{end}_id"))
        counts = names.select(F.col("label").alias(end), F.col("ends").alias("n"))
        return look_up(rows, ids, end, counts=counts).drop(end)

    encoded = encode(encode(links.select("src", "dst"), "src"), "dst")
    return encoded.select(
        F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), F.lit(1).cast("bigint").alias("weight")
    )


def build_graph(links: DataFrame, scratch: Scratch) -> Graph:
    """The graph of ``links(src, dst)``. The links are read twice, so pass a written table."""
    names = name_vertices(links, scratch)
    return Graph(names.select("id", "label"), encode_edges(links, names))


def graph_size(graph: Graph) -> DataFrame:
    """One row ``(edges, vertices)``."""
    vertices = graph.vertices.agg(F.count("*"))
    return graph.edges.agg(F.count("*").alias("edges")).withColumn("vertices", vertices.scalar())


def triplets(graph: Graph) -> DataFrame:
    """Each edge with the attributes of both its vertices, prefixed ``src_`` and ``dst_``; nulls
    for an end that has no vertex row. Hot vertices are left to Spark's skewed joins: the edges
    are the side that they may split."""
    found = graph.edges
    for end in ("src", "dst"):
        names = [F.col(c).alias(end if c == "id" else f"{end}_{c}") for c in graph.vertices.columns]
        found = found.join(graph.vertices.select(*names), end, "left")
    return found


def with_default_vertices(graph: Graph, **defaults: str) -> Graph:
    """Add a vertex with default attributes for every id that only edges name."""
    ends = edge_ends(graph.edges, "id").distinct()
    missing = ends.join(graph.vertices, "id", "left_anti")
    added = missing.select("id", *[F.lit(v).alias(c) for c, v in defaults.items()])
    return Graph(graph.vertices.unionByName(added), graph.edges)


def incident_triplets(graph: Graph, which: Column) -> DataFrame:
    """Triplets that touch the first vertex, by id, for which the condition holds.

    The edges are filtered before they meet the vertices.
    """
    vertex = graph.vertices.filter(which).agg(F.min("id")).scalar()
    touching = graph.edges.withColumn("_vertex", vertex)
    touching = touching.filter((F.col("src") == F.col("_vertex")) | (F.col("dst") == F.col("_vertex")))
    return triplets(Graph(graph.vertices, touching.drop("_vertex")))


def describe_triplet(src: str, attr: str, dst: str) -> Column:
    return F.format_string("%s--(%s)--%s", src, attr, dst)


def both_directions(edges: DataFrame) -> DataFrame:
    """``(id, neighbour)`` from either end of every edge; a loop counts twice."""
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("neighbour")),
        F.struct(F.col("dst").alias("id"), F.col("src").alias("neighbour")),
    )
    return edges.select(F.inline(ends))


def neighbour_ids(edges: DataFrame) -> DataFrame:
    """``(id, neighbour, n)``, where ``n`` edges join the two.

    Rows instead of one list per vertex: a hub's neighbours need not fit into one task.
    """
    return both_directions(edges).groupBy("id", "neighbour").agg(F.count("*").alias("n"))


def induced_subgraph(graph: Graph, ids: DataFrame) -> Graph:
    """Vertices in ``ids(id)``, and the edges that have both ends among them.

    Few ids are broadcast if Spark finds them small when it runs; of many, the edges of hot
    vertices are split by its skewed joins.
    """
    edges = graph.edges
    for end in ("src", "dst"):
        edges = edges.join(ids.select(F.col("id").alias(end)), end, "left_semi")
    return Graph(graph.vertices.join(ids, "id", "left_semi"), edges.select(*graph.edges.columns))
