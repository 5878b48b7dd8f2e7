"""Quality scores learned from preference pairs (Bradley and Terry, 1952).

Of two documents, one marked good and one marked bad, the good one is preferred; its score minus
the other's is the log-odds of that. The score is linear in features of the text, so the loss is
a logistic one on the differences of two feature rows. The scores are then set on a scale from 0
to 1 by the labels of the same sample, and a threshold may be taken at any quantile of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import as_bytes, mix, pieces, slices
from marginalia.llm.tables import pick

SAMPLE_ROWS = 20_000
PAIRS = 100_000
BLOCK = 256
LEVELS = 12

# Classes of bytes whose shares are features. Bytes from 128 on count as letters.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".?;:",
    "comma": b",",
    "loud": b"!",
    "bar": b"|",
    "odd": b"#$%&*@^~`_=+\\/<>[]{}",
    "quote": b"\"'()-",
    "blank": b" \t",
    "line": b"\n\r",
}
NAMES = [
    *CLASSES, *[f"most_{c}" for c in CLASSES], "letter", "high", "log_words", "word_length", "long_words", "distinct_words",
    "distinct_lines", "line_length", "same_as_last", "top_word",
]


def _shares(flags: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return (total[at[1:]] - total[at[:-1]]) / np.maximum(sizes, 1)


def _distinct(data: np.ndarray, first: np.ndarray, end: np.ndarray, owner: np.ndarray, texts: int):
    """Distinct shares per text, largest share of one value, and of values equal to the one before."""
    weight = mix(np.arange(256))[data]
    place = np.arange(len(data), dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(weight, dtype=np.uint64)]
    turned = np.r_[np.uint64(0), np.cumsum(weight * place, dtype=np.uint64)]
    plain = sums[end] - sums[first]
    value = mix(plain) ^ mix(turned[end] - turned[first] - plain * first.astype(np.uint64), 1)
    count = np.bincount(owner, minlength=texts)
    order = np.lexsort((value, owner))
    fresh = np.r_[True, (value[order][1:] != value[order][:-1]) | (owner[order][1:] != owner[order][:-1])][: len(order)]
    runs = np.diff(np.r_[np.flatnonzero(fresh), len(order)])
    top = np.zeros(texts)
    np.maximum.at(top, owner[order][fresh], runs)
    distinct = np.bincount(owner[order][fresh], minlength=texts)
    same = np.r_[False, (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])][: len(value)]
    most = np.maximum(count, 1)
    return distinct / most, top / most, np.bincount(owner[same], minlength=texts) / most


def text_features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` per text, of the whole text; an empty text has zeros."""
    texts, sizes = len(at) - 1, np.diff(at)
    out = np.zeros((texts, len(NAMES)))
    if not len(data):
        return out
    column = {n: i for i, n in enumerate(NAMES)}
    cuts = np.concatenate([np.arange(s, e, BLOCK) for s, e in zip(at[:-1], at[1:], strict=True)])
    block_size = np.minimum(np.r_[cuts[1:], len(data)] - cuts, BLOCK)
    block_owner = np.searchsorted(at, cuts, "right") - 1
    full = (block_size == BLOCK) | (sizes[block_owner] < BLOCK)  # a short last block says little
    block_at = np.r_[cuts, len(data)]
    letter = np.ones(len(data), bool)
    for name, members in CLASSES.items():
        lookup = np.zeros(256, bool)
        lookup[list(members)] = True
        flags = lookup[data]
        letter &= ~flags
        out[:, column[name]] = _shares(flags, at, sizes)
        most = np.zeros(texts)
        np.maximum.at(most, block_owner[full], _shares(flags, block_at, block_size)[full])
        out[:, column[f"most_{name}"]] = most
    out[:, column["letter"]] = _shares(letter, at, sizes)
    out[:, column["high"]] = _shares(data >= 128, at, sizes)
    first, end, owner = pieces(data, at, (data <= 32))
    words = np.bincount(owner, minlength=texts)
    length = np.bincount(owner, end - first, minlength=texts)
    out[:, column["log_words"]] = np.log1p(words)
    out[:, column["word_length"]] = length / np.maximum(words, 1)
    out[:, column["long_words"]] = np.bincount(owner[end - first > 20], minlength=texts) / np.maximum(words, 1)
    if len(first):
        out[:, column["distinct_words"]], out[:, column["top_word"]], out[:, column["same_as_last"]] = _distinct(data, first, end, owner, texts)
    first, end, owner = pieces(data, at, data == 10)
    if len(first):
        out[:, column["distinct_lines"]] = _distinct(data, first, end, owner, texts)[0]
    out[:, column["line_length"]] = np.log1p(sizes / np.maximum(np.bincount(owner, minlength=texts), 1))
    return out


class Ranker:
    """Levels of every feature, each level with a weight; the score is their sum."""

    def __init__(self, cuts: list[np.ndarray], weights: np.ndarray, slope: float, offset: float):
        self.cuts, self.weights, self.slope, self.offset = cuts, weights, slope, offset

    @staticmethod
    def levels(features: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        """Steps of each feature: 1 for every cut below its value."""
        return np.concatenate([(features[:, i, None] > c[None, :]).astype(np.float64) for i, c in enumerate(cuts)], axis=1)

    @classmethod
    def fit(cls, features: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranker:
        cuts = [np.unique(np.quantile(f, np.arange(1, LEVELS) / LEVELS)) for f in features.T]
        steps = cls.levels(features, cuts)
        pick_one = np.random.default_rng(seed)
        better, worse = np.flatnonzero(good), np.flatnonzero(~good)
        if not len(better) or not len(worse):
            return cls(cuts, np.zeros(steps.shape[1]), 1.0, 0.0)
        i, j = pick_one.choice(better, pairs), pick_one.choice(worse, pairs)
        weights = np.zeros(steps.shape[1])
        for _ in range(25):  # Newton steps on log(1 + exp(-w·(x_i - x_j))), ridge of 1
            gradient, curve = weights.copy(), np.eye(len(weights))
            score = steps @ weights
            for at in range(0, pairs, 10_000):
                a, b = i[at : at + 10_000], j[at : at + 10_000]
                miss = 1 / (1 + np.exp(np.clip(score[a] - score[b], -500, 500)))
                difference = steps[a] - steps[b]
                gradient -= difference.T @ miss
                curve += difference.T @ (difference * (miss * (1 - miss))[:, None])
            change = np.linalg.solve(curve, gradient)
            weights = weights - change
            if np.abs(change).max() < 1e-6:
                break
        slope, offset = cls._scale(steps @ weights, good)
        return cls(cuts, weights, slope, offset)

    @staticmethod
    def _scale(score: np.ndarray, good: np.ndarray) -> tuple[float, float]:
        """Logistic regression of the label on the score, softened after Platt."""
        hits, misses = good.sum(), (~good).sum()
        goal = np.where(good, (hits + 1) / (hits + 2), 1 / (misses + 2))
        spread = max(score.std(), 1e-9)
        x = np.stack([score / spread, np.ones(len(score))], axis=1)
        w = np.zeros(2)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            change = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - goal) + 1e-3 * w)
            w = w - np.clip(change, -2, 2)
            if np.abs(change).max() < 1e-8:
                break
        return w[0] / spread, w[1]

    def score(self, features: np.ndarray) -> np.ndarray:
        raw = self.levels(features, self.cuts) @ self.weights
        return 1 / (1 + np.exp(-np.clip(raw * self.slope + self.offset, -500, 500)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        rows = text_features(*as_bytes(part.column("text")))
        yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(list(rows), pa.list_(pa.float64()))], ["quality", "features"])


def fit_ranker(documents: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Ranker:
    """Fit on at most ``most`` of ``labels(doc_id, quality)``, those with the smallest hash of
    their id, and the texts in ``documents(doc_id, text)``.

    That bound holds for what is broadcast and for what comes to the driver. Labels other than 0
    and 1 are left out, as are documents without a label.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)
    known = documents.join(F.broadcast(sample), "doc_id").select("quality", "text")
    found = known.mapInArrow(_featured, "quality int, features array<double>").limit(2 * most).toArrow()
    features = np.array(found.column("features").to_pylist()).reshape(-1, len(NAMES))
    if not len(features):
        features, good = np.zeros((1, len(NAMES))), np.array([True])
    else:
        good = found.column("quality").to_numpy() == 1
        order = np.lexsort((*features.T, good))  # however the rows came in
        features, good = features[order], good[order]
    return Ranker.fit(features, good)


def score_documents(documents: DataFrame, ranker: Ranker) -> DataFrame:
    """``(doc_id, score)`` for every row of ``documents(doc_id, text)``, from the text alone.

    Null and empty texts are scored as texts without words. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            score = ranker.score(text_features(*as_bytes(part.column("text"))))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return documents.mapInArrow(run, "doc_id long, score double")


def quantile_threshold(scored: DataFrame, share: float) -> float:
    """The score below which about ``share`` of all documents lie."""
    return scored.agg(F.percentile_approx("score", share, 10_000)).first()[0] or 0.0


def held_out(doc_id: str = "doc_id"):
    """The fold no model sees: a checksum of the id, divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float | None = 0.3, share: float | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: learned outside the held-out fold, for all rows.

    ``predicted`` is 1 from ``threshold`` on, or, where that is None, from the ``share`` quantile
    of all scores on. A row with a null id is scored too and counts as not held out. Ties share
    their score and so their side.
    """
    texts = pick(documents, doc_id="doc_id", text="text")
    known = pick(labels, doc_id="doc_id", quality="quality").filter(~held_out())
    scored = score_documents(texts, fit_ranker(texts, known))
    if threshold is None:
        threshold = quantile_threshold(scored, share)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns; no shuffle."""
    known = pick(labels, doc_id="doc_id", quality="quality").filter(~held_out())
    ranker = fit_ranker(pick(documents, doc_id="doc_id", text="text"), known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            score = ranker.score(text_features(*as_bytes(part.column("text"))))
            yield part.filter(pa.array(score >= threshold))

    return documents.mapInArrow(run, documents.schema)
