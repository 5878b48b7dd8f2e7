import heapq
import math
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from conftest import plan
from marginalia.operators import embedding as e
from marginalia.operators import training as t
from marginalia.scratch import Scratch


def topics(spark, parts):
    dice = np.random.default_rng(2)
    words = [[f"{name}{i}" for i in range(8)] for name in "ab"]
    rows = [([str(w) for w in dice.choice(words[i % 2], 12)],) for i in range(1200)]
    return spark.createDataFrame(rows, "tokens array<string>").repartition(parts)


def test_slices_train_one_model(spark, monkeypatch):
    """Slices that hold a share of the corpus each find what one would; neither the driver nor the plan has the vectors."""
    monkeypatch.setattr(t, "BUCKET_BYTES", 200)
    monkeypatch.setattr(t, "ROUNDS_PER_WRITE", 3)
    model = e.train_word_vectors(topics(spark, 12), 12, 4, 14, partitions=4, seed=3)
    known = e.vector_table(model)
    assert "LocalTableScan" not in plan(known)
    rows = known.collect()
    assert len(rows) == 16 and all(len(r.vector) == 12 and all(map(math.isfinite, r.vector)) for r in rows)
    asked = spark.createDataFrame([(0, "a0"), (1, "b3")], "query_id bigint, expr string")
    found = e.word_query(asked, known, 6).collect()
    assert len(found) == 12 and all(r.word[0] == "ab"[r.query_id] for r in found)


def test_a_slice_holds_a_bounded_model():
    """More words give more slices, not larger ones."""
    counts = {n: 10_000_000 // (n * n) for n in range(5, 2_000)}
    tokens = sum(n * words for n, words in counts.items())

    def held(slices):
        return sum(words / 2**k * (1 - math.exp(-n * 2**k / slices)) for n, words in counts.items() for k in range(40)) * 300 * 4

    slices = t._slice_count(counts, tokens, 300, 4)
    assert held(4) > t.MODEL_BYTES >= held(slices) and slices > 4
    assert t._slice_count({5: 100}, 500, 300, 4) == 4


@pytest.mark.parametrize("seed", range(40))
def test_code_lengths_are_those_of_huffman(seed):
    dice = random.Random(seed)
    weights = [dice.choice([5, 6, 7, 9, dice.randint(5, 10**6)]) for _ in range(dice.randint(1, 200))]
    lengths = [length for length, words in t.code_lengths(dict(Counter(weights))).items() for _ in range(words)]
    merged, cost = sorted(weights), 0
    while len(merged) > 1:
        both = heapq.heappop(merged) + heapq.heappop(merged)
        cost += both
        heapq.heappush(merged, both)
    assert len(lengths) == len(weights)
    assert sum(a * b for a, b in zip(lengths, sorted(weights, reverse=True))) == cost


def test_odd_corpora(spark):
    """One word, null and empty sentences, null words, and no word that is frequent enough."""
    rows = [(["a"] * 6,), (None,), ([],), ([None] * 7,), (["b"],)]
    corpus = spark.createDataFrame(rows, "tokens array<string>")
    assert [(r.word, len(r.vector)) for r in e.train_word_vectors(corpus, 3, 2, 2, partitions=2).collect()] == [("a", 3)]
    with pytest.raises(ValueError, match="vocabulary size"):
        e.train_word_vectors(corpus.limit(0), 3, 2, 1)


def test_long_sentences_are_cut():
    assert t._cut(np.array([0, 3, 1000, 1001, 2500, 0])).tolist() == [3, 1000, 1000, 1, 1000, 1000, 500]


def frequent_and_rare():
    """A slice's words, the keys of words and nodes, and tokens whose neighbours are like each other; some
    sentences come many times in a row."""
    dice = np.random.default_rng(5)
    ranks = np.minimum(dice.zipf(1.3, (2000, 10)), 4000) * 2 + dice.integers(0, 2, (2000, 1))
    ranks = np.repeat(ranks, np.where(np.arange(2000) % 20, 1, 100), axis=0)
    _, tokens, counts = np.unique(ranks.ravel(), return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    words, code, length = [], 0, 0
    for longer, number in t.code_lengths(dict(Counter(counts.tolist()))).items():
        code, length = code << (longer - length), longer
        words += range((1 << length) + code, (1 << length) + code + number)
        code += number
    words = np.array(words)
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    return words, t._with_nodes(words), place[tokens].astype(np.int32), np.full(len(ranks), 10)


def above(key):
    """``(node, 1 for left and -1 for right)`` of all nodes above a word."""
    return [(key >> k, 1 - 2 * (key >> (k - 1) & 1)) for k in range(key.bit_length() - 1, 0, -1)]


def test_many_words_are_learnt():
    """Where tokens are trained many at a time, pairs become likelier than without any training, also
    where a batch has the same ones over and over."""
    words, keys, tokens, sizes = frequent_and_rare()
    assert len(words) > 8 * t.BATCH
    matrix = t._first_vectors(keys, words, 50, 1)

    def likelihood():
        total = 0
        for i in range(0, 3000, 10):
            for centre, context in zip(tokens[i + 1 : i + 10], tokens[i : i + 9], strict=True):
                x = matrix[np.searchsorted(keys, words[context])]
                total -= sum(np.logaddexp(0, -s * (x @ matrix[np.searchsorted(keys, node)])) for node, s in above(int(words[centre])))
        return total / 2700

    before = likelihood()
    for number in range(2):
        t._train(matrix, keys, words, tokens, sizes, 3, number, 2, np.random.default_rng(number))
    assert np.isfinite(matrix).all() and likelihood() > before


@pytest.mark.parametrize("size", [0.1, 2.0])
def test_a_batch_is_the_sum_of_its_pairs(size):
    """Also where windows reach over the ends of sentences, of which one has a single word; none goes too far."""
    dice = np.random.default_rng(4)
    words = np.array([2, 12, 13, 14, 15])
    keys = t._with_nodes(words)
    tokens, sizes = dice.integers(0, 5, 8).astype(np.int32), np.array([5, 1, 2])
    matrix = dice.normal(0, size, (len(keys), 6)).astype(np.float32)
    changes, met = np.zeros((len(keys), 6)), np.zeros(len(keys))
    ends, width = np.cumsum(sizes), 3 - np.random.default_rng(7).integers(0, 3, 8)
    for i in range(8):
        s = np.searchsorted(ends, i, "right")
        for j in range(max(ends[s] - sizes[s], i - width[i]), min(ends[s], i + width[i] + 1)):
            for node, side in above(int(words[tokens[i]])) if i != j else ():
                x, y = np.searchsorted(keys, (words[tokens[j]], node))
                product = float(matrix[x] @ matrix[y])
                pull = side / (1 + math.exp(side * product)) if abs(product) < t.MAX_EXPONENT else 0
                changes[x], changes[y] = changes[x] + pull * matrix[y], changes[y] + pull * matrix[x]
                met[x], met[y] = met[x] + matrix[y] @ matrix[y], met[y] + matrix[x] @ matrix[x]
    assert (met.max() * t.STEP / 4 > 1) == (size > 1)
    expected = matrix + changes * (t.STEP / np.maximum(1, met * t.STEP / 4))[:, None]
    t._train(matrix, keys, words, tokens, sizes, 3, 0, 1, np.random.default_rng(7))
    assert np.allclose(matrix, expected, atol=1e-5)


def test_waves_of_slices_train_the_same_model(spark, monkeypatch):
    """Also where sums go from wave to wave. Nothing but what the vectors are read from is left behind."""
    corpus = topics(spark, 30)
    monkeypatch.setattr(t, "PIECE_TOKENS", 200)
    monkeypatch.setattr(t, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(t, "ENCODED_TOKENS", 4_000)
    found = []
    for size in (0, t.WAVE_BYTES):
        monkeypatch.setattr(t, "WAVE_BYTES", size)
        scratch = Scratch(spark)
        vectors = t.train(corpus, 12, 4, 2, 2 * spark.sparkContext.defaultParallelism, 5, 3, scratch)
        found.append({r.word: r.vector for r in vectors.collect()})
        assert sorted(p.name[4:] for p in Path(scratch.path.removeprefix("file:")).iterdir()) == ["keys", "ordered", "vectors"]
    assert len(found[0]) == 16 and found[0].keys() == found[1].keys()
    assert all(np.allclose(found[0][word], found[1][word], atol=1e-6) for word in found[0])


def test_a_wave_sends_its_own_vectors_only(spark, monkeypatch):
    """Nothing that was shuffled for a wave is left when its sums are written."""
    keep, left = Scratch.keep_bucketed, []

    def shuffled():
        time.sleep(0.5)
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return manager.getAllFiles().mkString("\n").count("/shuffle_")

    def kept(*args, **options):
        found = keep(*args, **options)
        left.append(shuffled())
        return found

    monkeypatch.setattr(Scratch, "keep_bucketed", kept)
    monkeypatch.setattr(t, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(t, "PIECE_TOKENS", 200)
    monkeypatch.setattr(t, "WAVE_BYTES", 0)
    corpus = topics(spark, 30).localCheckpoint()
    before = shuffled()
    t.train(corpus, 12, 4, 2, 2 * spark.sparkContext.defaultParallelism, 5, 3, Scratch(spark))
    assert len(left) == 7 and max(left) <= before


def test_words_and_numbers_are_packed_whole():
    words = pa.array(["", "né", "x" * 300, "", "語"])
    assert t._unpacked_words(*t._packed_words(words)).equals(words)
    assert t._unpacked_words(*t._packed_words(words[1:4])).to_pylist() == ["né", "x" * 300, ""]
    assert t._unpacked_words(*t._packed_words(words[:0])).to_pylist() == []
    for numbers in (np.array([-1, 0, 2**31 - 1, 258], "<i4"), np.zeros(0, "<i4")):
        assert t._unpacked(t._packed(numbers), "<i4").tolist() == numbers.tolist()
    keys = np.array([1, 2, 2**40, 2**62])
    assert t._unpacked_keys(t._packed_keys(keys)).tolist() == keys.tolist()
