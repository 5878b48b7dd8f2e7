"""Embedding whitening: covariance by Spark, its leading components by contour integration (FEAST).

Spark gathers the distinct integer vectors, their sums and their centred covariance, a row per
dimension and task; only numbers by dimension reach the driver, never rows. There the symmetric
matrix, whose size the dimension bounds, is split into eigenvalue intervals by inertia counts. For
each, quadrature over a circle of complex shifted solves projects a few random vectors onto the
interval's eigenspace, Rayleigh-Ritz extracts the components, and the inertia count tells whether
any is missed. The rows are then projected where they are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from marginalia.llm.batches import as_bytes, ragged
from marginalia.llm.tables import pick
from marginalia.scratch import Scratch

SCALE = 256
COMPONENTS = 4

#: Nodes of the quadrature on the upper half of a circle; the lower half is its mirror image.
NODES = 8
#: Eigenvalues closer than this, by the largest, share an interval; so small ones count as zero.
TOGETHER, NOTHING = 1e-6, 1e-13
#: Vectors beyond the interval's count that the subspace takes, and iterations before it is widened.
SPARE, ROUNDS = 3, 30

BIGGEST = 2.0**63
LIMB = 28


class Whitening(NamedTuple):
    """What is fitted: ``n`` distinct vectors with ``sums`` by dimension, components by row with
    their ``values``, the covariance's ``trace`` and the largest error of the whitened covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


# --- eigenvalue intervals ------------------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``a`` (Householder)."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        inner = a[k + 1 :, k + 1 :]
        p = inner @ x
        p -= x * (x @ p)
        inner -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie below the shift: the negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny
    below, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        below += pivot < 0
    return int(below)


def place_of(diagonal: np.ndarray, off: np.ndarray, rank: int, low: float, high: float) -> float:
    """The eigenvalue of that rank from below (from 0), by bisection on inertia counts."""
    while high - low > TOGETHER / 8:
        middle = (low + high) / 2
        if count_below(diagonal, off, middle) > rank:
            high = middle
        else:
            low = middle
    return (low + high) / 2


def intervals(diagonal: np.ndarray, off: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """Intervals that hold the ``k`` largest eigenvalues, and with them all that are close to any of
    these, with the number in each by inertia. The matrix is scaled to eigenvalues of at most 1."""
    n = len(diagonal)
    places = []
    while len(places) < n and (len(places) <= k or places[-2] - places[-1] <= TOGETHER):
        places.append(place_of(diagonal, off, n - 1 - len(places), -1.0, 2.0))
    last = len(places) == n and (n <= k or places[-2] - places[-1] <= TOGETHER)
    chosen = places if last else places[:-1]
    groups: list[list[float]] = []
    for p in chosen:
        if groups and groups[-1][-1] - p <= TOGETHER:
            groups[-1].append(p)
        else:
            groups.append([p])
    found = []
    for i, group in enumerate(groups):
        above = groups[i - 1][-1] if i else 2.0
        below = groups[i + 1][0] if i + 1 < len(groups) else -1.0 if last else places[-1]
        room = min(above - group[0], group[-1] - below) / 2
        low, high = group[-1] - room, group[0] + room
        found.append((low, high, count_below(diagonal, off, high) - count_below(diagonal, off, low)))
    return found


def eigenpairs(a: np.ndarray, low: float, high: float, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of symmetric ``a`` between the bounds and their vectors, by column: a
    contour's quadrature as the filter of a subspace iteration, checked against the count."""
    n, size = len(a), min(len(a), count + SPARE)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 - nodes))
    shifted = (centre + radius * turns)[:, None, None] * np.eye(n) - a
    shares = (weights / 2 * radius * turns)[:, None, None]
    draw = np.random.default_rng(seed)
    while True:
        y, best = draw.standard_normal((n, size)), np.inf
        for _ in range(ROUNDS):
            q, _ = np.linalg.qr(np.real(shares * np.linalg.solve(shifted, np.broadcast_to(y, (NODES, *y.shape)))).sum(axis=0))
            values, mix = np.linalg.eigh(q.T @ a @ q)
            y = q @ mix
            inside = (values > low) & (values < high)
            left = np.abs(a @ y[:, inside] - y[:, inside] * values[inside]).max(initial=0.0)
            if inside.sum() == count and (left <= 1e-15 or left >= best / 2 and left <= 1e-13):
                return values[inside], y[:, inside]
            best = min(best, left) if inside.sum() == count else np.inf
        if size == n:
            raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues found between {low} and {high}")
        size = min(n, 2 * size)


def leading(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors by row; none that is zero by
    rounding."""
    scale = np.abs(covariance).sum(axis=0).max(initial=0.0)
    if not scale or not k:
        return np.zeros(0), np.zeros((0, len(covariance)))
    a = covariance / scale
    diagonal, off = tridiagonal(a)
    basis = [eigenpairs(a, *interval)[1] for interval in intervals(diagonal, off, min(k, len(a)))]
    q, _ = np.linalg.qr(np.hstack(basis))
    values, mix = np.linalg.eigh(q.T @ a @ q)
    vectors = (q @ mix).T[::-1]
    values = np.einsum("ij,jk,ik->i", vectors, a, vectors)
    some = (values > NOTHING * len(a))[:k]
    return values[:k][some] * scale, vectors[:k][some]


# --- vectors -------------------------------------------------------------------------------


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of a column of lists without nulls: the rows of each length, and their values as a matrix."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, values[ragged(starts[rows], sizes[rows])].reshape(len(rows), size)


def as_integers(values: np.ndarray) -> np.ndarray:
    """``floor(256 c)``, at the ends of 64 bits where it lies beyond them."""
    with np.errstate(over="ignore"):
        whole = np.floor(SCALE * values.astype(np.float64))
    top = whole >= BIGGEST
    found = np.where(top | (whole < -BIGGEST), 0, whole).astype(np.int64)
    return np.where(top, np.iinfo(np.int64).max, np.where(whole < -BIGGEST, np.iinfo(np.int64).min, found))


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(size, x)``: integer vectors as bytes, of the least width that holds each vector."""
    for batch in batches:
        for _, values in by_length(batch.column("embedding")):
            x = as_integers(values)
            ends = np.stack([x.min(axis=1, initial=0), x.max(axis=1, initial=0)])
            width = np.full(len(x), 8)
            for w in (4, 2):
                limits = np.iinfo(f"<i{w}")
                width[(ends[0] >= limits.min) & (ends[1] <= limits.max)] = w
            for w in np.unique(width):
                own = x[width == w].astype(f"<i{w}")
                packed = [row.tobytes() for row in own]
                yield pa.record_batch([pa.array(np.full(len(own), x.shape[1]), pa.int32()), pa.array(packed, pa.binary())], ["size", "x"])


def _unpack(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    data, at = as_bytes(column)
    long = np.diff(at)
    for n in np.unique(long):
        rows = np.flatnonzero(long == n)
        yield data[ragged(at[rows], long[rows])].view(f"<i{n // size}").reshape(len(rows), size).astype(np.int64)


def _sums(size: int) -> Callable:
    """``(place, total)``: the task's exact sums by dimension, and at place -1 its rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * size
        for batch in batches:
            for x in _unpack(batch.column("x"), size):
                n += len(x)
                small = np.abs(x.astype(np.float64)).max(initial=0.0) * len(x) < 2.0**62
                totals = [a + int(b) for a, b in zip(totals, x.sum(axis=0) if small else x.astype(object).sum(axis=0), strict=True)]
        if n:
            numbers = pa.array([*map(str, [n, *totals])], pa.string())
            yield pa.record_batch([pa.array(range(-1, size), pa.int32()), numbers], ["place", "total"])

    return run


def _products(mean: np.ndarray, onto: np.ndarray | None = None) -> Callable:
    """``(place, products)``: by row, the task's sum of products of the centred vectors, or of their
    places along ``onto``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 0))
        for batch in batches:
            for x in _unpack(batch.column("x"), len(mean)):
                y = x - mean
                y = y if onto is None else y @ onto
                total = y.T @ y + (total if total.size else 0)
        if total.size:
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["place", "products"])

    return run


def _summed(rows: DataFrame, mean: np.ndarray, n: int, onto: np.ndarray | None = None) -> np.ndarray:
    """The covariance over the rows: partial products summed by Spark, a row per dimension here."""
    total = vector_to_array(Summarizer.sum(array_to_vector("products"))).alias("products")
    partial = rows.mapInArrow(_products(mean, onto), "place int, products array<double>")
    found = np.array([r.products for r in sorted(partial.groupBy("place").agg(total).collect())])
    return (found + found.T) / (2 * n)


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embedding.isNotNull() & finite


def _usable_rows(embeddings: DataFrame) -> DataFrame:
    rows = pick(embeddings, vec_id="vec_id", embedding="embedding")
    rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return rows.filter(usable(F.col("embedding")))


def fit_whitening(embeddings: DataFrame, scratch: Scratch, k: int = COMPONENTS) -> Whitening | None:
    """Fit on each distinct integer vector once; None without any.

    Vectors that are null or hold null or non-finite entries are left out, and so are those whose
    length is not that of most distinct vectors (of equally many, the longer). Fewer than ``k``
    components are found where fewer dimensions vary.
    """
    packed = _usable_rows(embeddings).select("embedding").mapInArrow(_pack, "size int, x binary")
    fit = scratch.keep(packed.distinct(), "fit")
    lengths = fit.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).head(1)
    if not lengths:
        return None
    size = lengths[0]["size"]
    fit = fit.filter(F.col("size") == size).select("x")
    totals = fit.mapInArrow(_sums(size), "place int, total string") if size else fit.select(F.lit(-1).alias("place"), F.lit("1").alias("total"))
    summed = totals.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    n, *sums = [int(r.total) for r in sorted(summed.collect())]
    if not size:
        return Whitening(n, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    mean = np.array([s / n for s in sums])
    covariance = _summed(fit, mean, n)
    values, components = leading(covariance, k)
    error = 0.0
    if len(values):
        whitened = _summed(fit, mean, n, components.T / np.sqrt(values))
        error = float(np.abs(whitened - np.eye(len(values))).max())
    return Whitening(n, sums, components, values, float(np.trace(covariance)), error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """``Σ (n x - S)²`` of each row, exactly."""
    most = n * int(np.abs(x.astype(np.float64)).max(initial=0.0)) + max(map(abs, sums), default=0)
    if most >= 1 << 56:
        gaps = x.astype(object) * n - np.array(sums, object)
        return [int(v) for v in (gaps * gaps).sum(axis=1)]
    gaps = x * n - np.array(sums, np.int64)
    high, low = gaps >> LIMB, gaps & ((1 << LIMB) - 1)
    found = [0] * len(x)
    for at in range(0, x.shape[1], 64):  # so many products of two limbs fit into 64 bits
        h, m = high[:, at : at + 64], low[:, at : at + 64]
        parts = zip(found, (h * h).sum(axis=1).tolist(), (h * m).sum(axis=1).tolist(), (m * m).sum(axis=1).tolist(), strict=True)
        found = [v + (a << 2 * LIMB) + (b << LIMB + 1) + c for v, a, b, c in parts]
    return found


def _whiten(fitted: Whitening) -> Callable:
    most = 10**38

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        onto, k = fitted.components.T / np.sqrt(fitted.values), len(fitted.values)
        for batch in batches:
            for rows, values in by_length(batch.column("embedding")):
                if values.shape[1] != len(fitted.sums):
                    continue
                x = as_integers(values)
                exact = pa.array([str(v) if v < most else None for v in deviations(x, fitted.n, fitted.sums)], pa.string())
                each = pa.array(np.repeat(np.arange(len(rows)), k))
                yield pa.record_batch(
                    [
                        batch.column("vec_id").take(pa.array(rows)).take(each),
                        pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                        exact.take(each),
                        pa.array(((x - fitted.mean) @ onto).ravel(), pa.float64()),
                    ],
                    ["vec_id", "component", "deviation", "whitened"],
                )

    return run


def whiten(embeddings: DataFrame, fitted: Whitening | None) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: every usable row
    along every component. Repeated rows and null ids stay; without usable rows, or where nothing
    varies, there is no row. A deviation of more than 38 digits is null."""
    rows = _usable_rows(embeddings)
    key = rows.schema["vec_id"]
    if fitted is None or not len(fitted.values):
        columns = (("component", IntegerType()), ("n", LongType()), ("deviation", DecimalType(38, 0)), ("whitened", DoubleType()), ("explained", DoubleType()), ("identity_error", DoubleType()))
        return embeddings.sparkSession.createDataFrame([], StructType([key, *(StructField(*c) for c in columns)]))
    made = StructType([key]).add("component", IntegerType()).add("deviation", "string").add("whitened", DoubleType())
    found = rows.mapInArrow(_whiten(fitted), made)
    explained = F.element_at(F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values]), F.col("component"))
    return found.select(
        "vec_id",
        "component",
        F.lit(fitted.n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        explained.alias("explained"),
        F.lit(fitted.error).alias("identity_error"),
    )


def whitened_embeddings(embeddings: DataFrame, scratch: Scratch) -> DataFrame:
    """The operator's rows with the deviation as a long, null beyond 64 bits."""
    found = whiten(embeddings, fit_whitening(embeddings, scratch))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
