"""Weakly connected components by alternating large-star and small-star rounds
(Kiveris et al., Connected Components in MapReduce and Beyond, SoCC 2014).

Before the first round, tasks unite what they can see by themselves: of the edges they read, then of
the rows on neighbouring ids. What they hand on is a star per piece, no larger than its vertices.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.operators.graph import edge_ends
from marginalia.scratch import Scratch

# A task unites so many rows at a time.
UNITED_ROWS = 1_000_000


def lowest_connected(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids at either end of some edges, sorted, and the lowest that each is connected with."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(ids))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return ids, ids[root]
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (further := root[root]).sum() != root.sum():  # no root is ever raised
            root = further


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(high, low)``: every vertex of some rows but the lowest of each piece, with that lowest."""

    def united(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in (0, 1)]
        ids, low = lowest_connected(*ends)
        other = ids != low
        return pa.record_batch([pa.array(ids[other]), pa.array(low[other])], ["high", "low"])

    parts, rows = [], 0
    for batch in batches:
        parts.append(batch)
        rows += batch.num_rows
        if rows >= UNITED_ROWS:
            yield united(parts)
            parts, rows = [], 0
    if rows:
        yield united(parts)


def _smallest(pairs: DataFrame, key: str) -> DataFrame:
    """``(key, low)``: the smallest id that each larger end points to."""
    return pairs.groupBy(F.col("high").alias(key)).agg(F.min("low").alias("lowest"))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a vertex onto the smallest one around that vertex."""
    centres = _smallest(pairs, "low")
    return (
        pairs.join(centres, "low", "left")
        .select(
            "high",
            F.coalesce("lowest", "low").alias("low"),
            (F.col("moved") | F.col("lowest").isNotNull()).alias("moved"),
        )
        .groupBy("high", "low")
        .agg(F.max("moved").alias("moved"))
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of a vertex, and the vertex, onto the smallest of them."""
    centres = _smallest(pairs, "high")
    stays = F.struct("high", F.col("lowest").alias("low"), "moved")
    hangs = F.struct(F.col("low").alias("high"), F.col("lowest").alias("low"), F.lit(True).alias("moved"))
    both = F.when(F.col("low") == F.col("lowest"), F.array(stays)).otherwise(F.array(stays, hangs))
    return (
        pairs.join(centres, "high")
        .select(F.inline(both))
        .groupBy("high", "low")
        .agg(F.max("moved").alias("moved"))
    )


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, component)``: the component of a vertex is the lowest id in it.

    Every round rewrites a table no larger than the vertices the tasks could not settle. The rounds
    end when none of its rows moved, that is, when each vertex hangs directly onto a vertex that
    hangs onto nothing. The pairs are the large side of both joins, which Spark splits where a vertex
    is hot; no round counts its keys.
    """
    stars = "high long, low long"
    seen = scratch.keep(edges.filter(F.col("src") != F.col("dst")).select("src", "dst").mapInArrow(_stars, stars), "seen")
    near = seen.repartitionByRange("high").mapInArrow(_stars, stars)
    pairs = scratch.keep(near.distinct().withColumn("moved", F.lit(False)), "pairs")
    scratch.drop(seen)
    while True:
        before = pairs
        large = scratch.keep(_large_star(before.withColumn("moved", F.lit(False))), "large_star")
        pairs = scratch.keep(_small_star(large), "small_star")
        scratch.drop(before)
        scratch.drop(large)
        if pairs.filter("moved").isEmpty():
            break
    roots = edge_ends(edges, "id").distinct()
    return roots.join(pairs.withColumnRenamed("high", "id"), "id", "left").select(
        "id", F.coalesce("low", "id").alias("component")
    )


def community_count(components: DataFrame) -> DataFrame:
    return components.agg(F.countDistinct("component").alias("communities"))
