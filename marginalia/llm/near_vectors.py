"""Near duplicates among embeddings by counting collisions of one-dimensional projections
(after Gan et al., Locality-sensitive hashing scheme based on dynamic collision counting, 2012).

Unit vectors of cosine ``c`` lie ``sqrt(2 - 2c)`` apart, so on a random direction they fall about
``sqrt(2 - 2c) / sqrt(d)`` apart, while unrelated vectors spread over ``1 / sqrt(d)``. A pair
collides on a projection if one lies in the window around the other. Pairs with enough
collisions are verified by their cosine. How many are enough, and how many tables of cells are
needed for pairs to meet at all, follows from the share of pairs to be found.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, erf, log, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.tables import pick, shuffle_width
from marginalia.llm.topk_search import _matrix, usable
from marginalia.operators.components import connected_components
from marginalia.scratch import Scratch

PROJECTIONS = 24
RECALL = 0.995
CELL_ROWS = 1500
TILE_ROWS = 4096
CHUNK = 256


class Plan:
    """Directions, windows and cells for vectors of ``width`` numbers, the largest label ``rows`` long."""

    def __init__(self, width: int, rows: int, cosine: float, recall: float = RECALL, seed: int = 11):
        sigma = sqrt(2 - 2 * cosine) / sqrt(width)
        spread = 1 / sqrt(width)
        self.window = 2 * sigma
        hit = erf(self.window / (sigma * sqrt(2)))
        # The largest count that a pair at the threshold reaches with the wanted probability.
        tail, self.enough = 0.0, PROJECTIONS
        for n in range(PROJECTIONS, 0, -1):
            tail += comb(PROJECTIONS, n) * hit**n * (1 - hit) ** (PROJECTIONS - n)
            self.enough = n
            if tail >= recall:
                break
        self.cell = 4 * sigma
        together = 1 - sigma * sqrt(2 / pi) / self.cell
        apart = min(0.9, self.cell / (2 * spread * sqrt(pi)))
        self.depth = max(1, ceil(log(max(rows / CELL_ROWS, 1)) / -log(apart)))
        self.tables = ceil(log(1 - recall) / log(1 - together**self.depth))
        random = np.random.default_rng(seed)
        lines = random.normal(size=(width, PROJECTIONS + self.tables * self.depth))
        lines /= np.linalg.norm(lines, axis=0)
        self.count_on, self.cut_on = lines[:, :PROJECTIONS], lines[:, PROJECTIONS:]
        self.shift = random.random(self.tables * self.depth)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """One number per vector and table."""
        steps = np.floor(unit @ self.cut_on / self.cell + self.shift).astype(np.int64)
        steps = steps.reshape(len(unit), self.tables, self.depth)
        value = np.zeros((len(unit), self.tables), np.uint64)
        for i in range(self.depth):
            value = value * np.uint64(1_000_003) + steps[:, :, i].astype(np.uint64)
        return value.view(np.int64)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _lowest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the lowest one it is connected with."""
    low = np.arange(n)
    while True:
        before = low.copy()
        least = np.minimum(low[left], low[right])
        np.minimum.at(low, left, least)
        np.minimum.at(low, right, least)
        low = low[low]
        if (low == before).all():
            return low


def _tile(plan: Plan, cosine: float):
    """The links of one tile: per vector how many others (copies included) it links with, and
    the lowest vector of its part of the tile."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        table, first, second = int(rows["table"].iloc[0]), int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
        rows = rows.sort_values("vec_id", ignore_index=True)
        width = plan.count_on.shape[0]
        vectors = np.zeros((len(rows), width))
        for i, v in enumerate(rows["vector"]):
            vectors[i, : len(v)] = v
        unit = _unit(vectors)
        spots, cells = unit @ plan.count_on, plan.cells(unit)
        block, copies = rows["block"].to_numpy(), rows["copies"].to_numpy()
        here, there = np.flatnonzero(block == first), np.flatnonzero(block == second)
        there = there[np.argsort(spots[there, 0], kind="stable")]
        here = here[np.argsort(spots[here, 0], kind="stable")]
        line = spots[there, 0]
        left, right = [], []
        for at in range(0, len(here), CHUNK):
            some = here[at : at + CHUNK]
            lo = np.searchsorted(line, spots[some[0], 0] - plan.window, "left")
            hi = np.searchsorted(line, spots[some[-1], 0] + plan.window, "right")
            for from_ in range(lo, hi, TILE_ROWS):
                others = there[from_ : min(hi, from_ + TILE_ROWS)]
                count = np.zeros((len(some), len(others)), np.int8)
                for p in range(spots.shape[1]):
                    count += np.abs(spots[some, p, None] - spots[None, others, p]) <= plan.window
                i, j = np.nonzero(count >= plan.enough)
                i, j = some[i], others[j]
                if first == second:
                    i, j = i[i < j], j[i < j]
                near = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
                left.append(i[near])
                right.append(j[near])
        left = np.concatenate(left) if left else np.zeros(0, np.int64)
        right = np.concatenate(right) if right else np.zeros(0, np.int64)
        low = _lowest(len(rows), left, right)
        fresh = ~(cells[left, :table] == cells[right, :table]).any(axis=1)  # met in no earlier table
        links = np.bincount(left[fresh], copies[right[fresh]], len(rows)) + np.bincount(right[fresh], copies[left[fresh]], len(rows))
        found = np.unique(np.r_[left, right])
        ids = rows["vec_id"].to_numpy()
        return pd.DataFrame({"vec_id": ids[found], "links": links[found].astype(np.int64), "low": ids[low[found]]})

    return run


def near_vectors(vectors: DataFrame, scratch: Scratch, cosine: float = 0.98, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, vector, label)``.

    Two vectors link if their labels are equal and their cosine, in double precision, is at least
    ``cosine``; shorter ones count as padded with zeros. Null or zero vectors, those with null or
    non-finite components and those without a label link with nothing. No pair below ``cosine``
    is linked; of the pairs at it about ``recall`` squared are found, of closer ones more.

    Equal vectors of one label are looked at once, with their number. Rows with the same id, or
    with a null id, are taken as separate copies of it, and come back once. A cell's rows meet in
    tiles of two blocks of at most about ``TILE_ROWS``, so a hot cell is split over many tasks;
    pairs are counted and joined into parts within a tile and never written out.
    """
    spark = vectors.sparkSession
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    fine = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good = vectors.filter(fine).filter(length > 0).filter(length < float("inf"))
    members = good.withColumn("key", F.md5(F.concat_ws(",", F.col("label").cast("string"), F.array_join(F.col("vector").cast("array<string>"), " "))))
    one = scratch.keep(
        members.groupBy("key").agg(
            F.min("vec_id").alias("vec_id"), F.first("vector").alias("vector"), F.first("label").alias("label"),
            F.count_distinct("vec_id").alias("copies"),
        ),
        "distinct",
    )
    width = one.agg(F.max(F.size("vector"))).first()[0]
    ids = vectors.select("vec_id").distinct()
    if not width:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    largest = one.groupBy("label").count().agg(F.max("count")).first()[0]
    plan = Plan(width, largest, cosine, recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = plan.cells(_unit(_matrix(batch.column("vector"), width)))
                yield batch.append_column("cells", pa.array(list(cells), pa.list_(pa.int64())))

    kinds = {f.name: f.dataType.simpleString() for f in one.schema}
    placed = one.select("vec_id", "vector", "label", "copies").mapInArrow(
        place, f"vec_id {kinds['vec_id']}, vector {kinds['vector']}, label {kinds['label']}, copies long, cells array<bigint>"
    )
    placed = scratch.keep(placed, "cells")
    key = ["label", "table", "cell"]
    met = placed.select("vec_id", "label", F.posexplode("cells").alias("table", "cell"))
    sizes = met.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / TILE_ROWS).cast("int")
    rows = (
        placed.select("vec_id", "vector", "label", "copies", F.posexplode("cells").alias("table", "cell"))
        .join(sizes.select(*key, blocks.alias("blocks")), key)
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
        .drop("blocks", "other")
        .repartition(shuffle_width(vectors), *key, "first", "second")
    )
    found = scratch.keep(
        rows.groupBy(*key, "first", "second").applyInPandas(_tile(plan, cosine), "vec_id long, links long, low long"), "links"
    )
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("vec_id").alias("src"), F.col("low").alias("dst")), scratch)
    groups = (
        one.select("key", F.col("vec_id"), "copies").join(counts, "vec_id", "left")
        .join(parts.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    )
    known = members.select("vec_id", "key").join(groups, "key").groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    return ids.join(known, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def near_embeddings(embeddings: DataFrame, scratch: Scratch) -> DataFrame:
    return near_vectors(pick(embeddings, vec_id="vec_id", vector="embedding", label="label"), scratch)
