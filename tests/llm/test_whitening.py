"""Embedding whitening against brute force with exact integers, on odd inputs."""

import math
from fractions import Fraction

import numpy as np
import pytest

from marginalia.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, place int, x string"


def frame(spark, rows, kind="float", parts=3):
    return spark.createDataFrame([(i, v, 1, "c", "n", 0, "x") for i, v in rows], SCHEMA.replace("array<float>", f"array<{kind}>")).repartition(parts)


def integers(v):
    return tuple(max(-(2**63), min(2**63 - 1, math.floor(Fraction(float(c)) * 256))) for c in v)


def by_hand(rows):
    good = [(i, integers(v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array([[float(c - Fraction(s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    exact = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in good]
    centred = np.array([[float(c - Fraction(s, n)) for c, s in zip(x, sums, strict=True)] for _, x in good])
    return n, exact, values[::-1], vectors.T[::-1], centred, np.trace(covariance)


def vectors(seed, n=300, d=12):
    draw = np.random.default_rng(seed)
    found = (draw.standard_normal((n, d)) * np.linspace(2, 0.1, d) + draw.standard_normal(d)).astype(np.float32)
    return [(i, [float(c) for c in v]) for i, v in enumerate(found)]


def test_whitening_equals_brute_force(spark, scratch):
    rows = vectors(1)
    rows += [(500, rows[3][1]), (500, rows[3][1]), (None, rows[4][1]), (501, None), (502, [None] * 12), (503, [float("nan")] * 12), (504, [float("inf")] * 12), (505, [-0.0] * 12), (506, [0.0] * 12)]
    n, exact, values, components, centred, trace = by_hand(rows)
    got = wh.whitened_embeddings(frame(spark, rows), scratch)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes)["vec_id"] == "bigint" and dict(got.dtypes)["deviation"] == "bigint"
    found = got.collect()
    assert len(found) == 4 * len(exact) and {r.n for r in found} == {n}
    assert sorted((repr(r.vec_id), r.deviation) for r in found if r.component == 1) == sorted((repr(i), d) for i, d in exact)
    assert max(r.identity_error for r in found) < 1e-10
    for c in range(4):
        own = [r for r in found if r.component == c + 1]
        assert all(abs(r.explained - values[c] / trace) < 1e-10 for r in own)
        want = centred @ components[c] / math.sqrt(values[c])
        by_id = {i: w for (i, _), w in zip(exact, want, strict=True)}
        sign = np.sign(own[0].whitened * by_id[own[0].vec_id])
        assert all(abs(sign * r.whitened - by_id[r.vec_id]) < 1e-9 for r in own)


def test_large_and_ragged_vectors(spark, scratch):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [4e5, -4e5]), (4, [4e5, 4e5]), (5, [1.0, 2.0, 3.0]), (6, []), (7, [1e308, 1e308])]
    found = wh.whiten(frame(spark, rows, "double"), wh.fit_whitening(frame(spark, rows, "double"), scratch))
    n, exact, *_ = by_hand([r for r in rows if len(r[1]) == 2])
    assert n == 5 and {r.vec_id for r in found.collect()} == {1, 2, 3, 4, 7}
    for r in found.collect():
        want = dict(exact)[r.vec_id]
        assert r.deviation == (want if want < 10**38 else None)
    assert wh.whitened_embeddings(frame(spark, rows, "double"), scratch).filter("deviation is not null").count() < found.count()


@pytest.mark.parametrize("size", [1 << 20, 1 << 44, 1 << 55])
def test_deviations_are_exact(size):
    draw = np.random.default_rng(2)
    x = draw.integers(-size, size, (50, 130))
    sums = [int(s) for s in x.sum(axis=0)]
    want = [sum((50 * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
    assert wh.deviations(x, 50, sums) == want


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, [])]])
def test_nothing_varies(spark, scratch, rows):
    found = wh.whitened_embeddings(frame(spark, rows), scratch)
    assert found.count() == 0 and len(found.columns) == 7


def test_fewer_components_than_asked_for(spark, scratch):
    rows = [(1, [1.0, 2.0, 0.0]), (2, [2.0, 4.0, 0.0]), (3, [4.0, 8.0, 0.0])]
    found = wh.whitened_embeddings(frame(spark, rows), scratch).collect()
    assert [r.component for r in found] == [1, 1, 1] and abs(found[0].explained - 1) < 1e-12


MATRICES = {
    "one": np.array([[3.0]]),
    "identity": np.eye(7),
    "ties": np.diag([5.0, 5, 5, 5, 5, 1]),
    "spread": np.diag([1e6, 1.0, 1e-3, 1e-5, 1e-9]),
    "close": np.diag([9, 9 - 1e-7, 9 - 2e-5, 4, 3, 2.0]),
    "negative": np.diag([2.0, 1.0, 0.5, -1e-17]),
}
for _d in (2, 5, 64, 130):
    _b = np.random.default_rng(_d).standard_normal((3 * _d, _d))
    MATRICES[f"random {_d}"] = _b.T @ _b


@pytest.mark.parametrize("name", MATRICES)
@pytest.mark.parametrize("k", [1, 4])
def test_components_are_eigenvectors(name, k):
    a = MATRICES[name]
    draw, _ = np.linalg.qr(np.random.default_rng(3).standard_normal(a.shape))
    a = draw @ a @ draw.T
    a = (a + a.T) / 2
    values, vectors = wh.leading(a, k)
    want = np.linalg.eigvalsh(a)[::-1]
    kept = int((want[:k] > 1e-12 * want[0]).sum())
    assert len(values) == min(k, kept)
    assert np.abs(values - want[: len(values)]).max() <= 1e-13 * want[0] * len(a)
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-13 * want[0] * len(a)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13


def test_inertia_counts_all_eigenvalues():
    a = MATRICES["random 64"]
    diagonal, off = wh.tridiagonal(a)
    for shift in np.linspace(-1, np.linalg.eigvalsh(a)[-1] + 1, 23):
        assert wh.count_below(diagonal, off, shift) == (np.linalg.eigvalsh(a) < shift).sum()
