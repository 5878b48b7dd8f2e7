"""Exact search for the largest inner products (after Li et al., FEXIPRO, SIGMOD 2017).

Candidates are taken by falling length. All vectors are turned by the principal axes of the
candidates, so the first coordinates hold most of every product. A candidate is worked out in
full only if its product over the first coordinates, plus the product of the lengths of both
rests (Cauchy-Schwarz), can still reach the query's k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm.tables import pick, shuffle_width
from marginalia.scratch import Scratch

BLOCK = 1024
QUERY_BLOCK = 4096
SEEDS = 1024
LEADING = 0.5
EXACT = 2.0**53


def usable(vector: Column) -> Column:
    """Not null, and no component null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def scaled(vector: Column, scale: float = 256.0) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width``."""
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(at)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(at[0], at[-1]) - np.repeat(at[:-1], sizes)] = flat[at[0] : at[-1]]
    return out


def _second_moments(vectors: DataFrame, width: int) -> np.ndarray:
    """``Σ v vᵀ`` over all vectors: one matrix per task, summed by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            total += rows.T @ rows
        cell = np.arange(width * width)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total.ravel())], ["cell", "v"])

    sums = vectors.select("vector").mapInArrow(partial, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    out = np.zeros(width * width)
    for cell, v in sums.collect():
        out[cell] = v
    return out.reshape(width, width)


class _Best:
    """The k best scores of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.scores = [np.zeros(0) for _ in range(queries)]
        self.ids = [np.zeros(0, np.int64) for _ in range(queries)]
        self.k, self.bar = k, floor.copy()

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores[query], scores), np.append(self.ids[query], ids)
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[best], ids[best]
        if len(best) == self.k:
            self.bar[query] = max(self.bar[query], scores[best[-1]])


def top_products(
    vectors: DataFrame, is_query: Column, scratch: Scratch, k: int = 5, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` largest inner products.

    ``vectors(vec_id, vector array<bigint>)`` hold whole numbers, without nulls. Shorter vectors
    count as padded with zeros, empty ones as zero. Rows with the same id count once, the smaller
    vector stays; rows without an id take no part. A query does not find its own id.

    Queries go in blocks of about ``query_block``, each broadcast once and held against all
    candidates, so a task holds one block of queries and one of candidates. The rotation is fitted
    on all vectors; what the driver holds is one square matrix, one block of queries and the
    ``SEEDS`` longest candidates, which give every query a first score to reach.
    """
    one = vectors.filter(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    by_length = (
        one.withColumns({"norm": norm, "asks": F.coalesce(is_query, F.lit(False))})
        .repartitionByRange(shuffle_width(vectors), F.desc("norm"), "vec_id")
        .sortWithinPartitions(F.desc("norm"), "vec_id")
    )
    held = scratch.keep(by_length, "by_length")
    width, many, longest = held.agg(
        F.max(F.size("vector")), F.count(F.when(F.col("asks"), 1)), F.max("norm")
    ).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not many or not width:
        return held.sparkSession.createDataFrame([], out)
    if longest >= EXACT:
        raise ValueError("products beyond 2^53 are not exact")
    axes = np.linalg.eigh(_second_moments(held, width))[1][:, ::-1].copy()
    lead = max(1, int(width * LEADING))
    # Rounding of one product of rotated vectors, generously: the bound may only be too high.
    slack = longest * width * 1e-14 + 1e-6
    seeds = held.orderBy(F.desc("norm"), "vec_id").limit(SEEDS).select("vec_id", "vector").toArrow()
    seed_ids = seeds.column(0).to_numpy()
    seed_rows = _matrix(seeds.column(1).combine_chunks(), width)
    blocks = -(-many // query_block)
    asking = held.filter("asks").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        batch = asking.filter(F.col("block") == block).select("vec_id", "vector").toArrow()
        if not batch.num_rows:
            continue
        ids, rows = batch.column(0).to_numpy(), _matrix(batch.column(1).combine_chunks(), width)
        known = np.where(ids[:, None] == seed_ids[None, :], -np.inf, rows @ seed_rows.T)
        floor = -np.partition(-known, k - 1, axis=1)[:, k - 1] if known.shape[1] >= k else np.full(len(ids), -np.inf)
        sent = held.sparkSession.sparkContext.broadcast((ids, rows, floor, axes))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, rows, floor, axes = sent.value
            turned = rows @ axes
            length = np.sqrt((rows * rows).sum(1))
            rest = np.sqrt((turned[:, lead:] ** 2).sum(1))
            best = _Best(len(ids), k, floor)
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(at, BLOCK)
                    names, plain = part.column(0).to_numpy(), _matrix(part.column(1), width)
                    reach = np.sqrt((plain * plain).sum(1))
                    # Lengths fall: a query this block's longest cannot serve is done with it.
                    live = np.flatnonzero(length * reach.max() + slack >= best.bar)
                    if not len(live):
                        continue
                    other = plain @ axes
                    bound = turned[live, :lead] @ other[:, :lead].T
                    bound += np.outer(rest[live], np.sqrt((other[:, lead:] ** 2).sum(1))) + slack
                    maybe = (bound >= best.bar[live, None]) & (ids[live, None] != names[None, :])
                    for i in np.flatnonzero(maybe.any(1)):
                        some = np.flatnonzero(maybe[i])
                        scores = plain[some] @ rows[live[i]]
                        hit = scores >= best.bar[live[i]]
                        if hit.any():
                            best.add(live[i], scores[hit], names[some[hit]])
            sizes = [len(x) for x in best.ids]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids, sizes), pa.int64()),
                    pa.array(np.concatenate(best.ids), pa.int64()),
                    pa.array(np.rint(np.concatenate(best.scores)).astype(np.int64)),
                ],
                ["query_id", "vec_id", "score"],
            )

        part = held.select("vec_id", "vector").mapInArrow(search, "query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def embedding_search(embeddings: DataFrame, scratch: Scratch, each: int = 50, k: int = 5) -> DataFrame:
    """Search the embeddings, in steps of 1/256, for the rows whose id is divisible by ``each``."""
    rows = pick(embeddings, vec_id="vec_id", vector="embedding").filter(usable(F.col("vector")))
    whole = rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("vector")).alias("vector"))
    return top_products(whole, F.col("vec_id") % each == 0, scratch, k)
