import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan
from marginalia.functions import vectors as v
from marginalia.operators import embedding as e
from marginalia.plans import mining


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0]), ("d", [-1.0, 0.0])]
    return spark.createDataFrame(rows, "word string, vector array<double>")


HALF = 0.707107
LIKE_A = [("a", 1.0), ("c", HALF), ("b", 0.0), ("d", -1.0)]


@pytest.mark.parametrize(
    "query, want",
    [
        ("a + b", [("c", 1.0), ("a", HALF), ("b", HALF), ("d", -HALF)]),
        ("c - b", LIKE_A),
        ("A+zzz", LIKE_A),
        ("zzz", []),
        ("-a+b", [("b", HALF), ("d", HALF), ("c", 0.0), ("a", -HALF)]),
        ("a--b", None),
    ],
)
def test_queries(table, query, want):
    found = [(r.word, round(r.similarity, 6)) for r in mining.answer(table, query, 4).collect()]
    if want is None:
        assert found == [(r.word, round(r.similarity, 6)) for r in mining.answer(table, "a-b", 4).collect()]
    else:
        assert sorted(found) == sorted(want)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)


def test_sums_and_synonyms(table):
    found = [r.word for r in e.sum_words(table, "a", "B", 2).collect()]
    assert found == ["c", "a"]
    minus = [(r.word, round(r.similarity, 6)) for r in e.sum_words(table, "c", "b", 4, minus=True).collect()]
    assert minus == LIKE_A
    assert [r.word for r in e.synonyms(table, e.word_vector(table, "A"), 2).collect()] == ["a", "c"]
    assert e.synonyms(table, e.word_vector(table, "zzz"), 2).count() == 0


def test_arithmetic(spark):
    row = spark.createDataFrame([([1.0, 2.0], [3.0, 5.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    found = row.select(
        v.add(a, b), v.subtract(a, b), v.opposite(v.opposite(a)), v.distance(a, b), v.dot(a, b), v.cosine(a, z), v.cosine(a, a)
    ).first()
    assert found[:3] == ([4.0, 7.0], [-2.0, -3.0], [1.0, 2.0])
    assert found[3:] == pytest.approx((math.sqrt(13), 13.0, 0.0, 1.0))


def test_distance_and_documents(spark, table):
    words = spark.createDataFrame([(w,) for w in "abcdz"], "word string")
    found = [(r.word, round(r.distance, 6)) for r in e.nearest_euclid(words, table, "a").collect()]
    assert found == [("a", 0.0), ("c", 1.0), ("z", 1.0), ("b", 1.414214), ("d", 2.0)]
    unknown = e.nearest_euclid(words, table, "z", 1).collect()
    assert [tuple(r) for r in unknown] == [("z", 0.0)]
    documents = spark.createDataFrame(
        [(1, ["a", "zzz"]), (2, []), (3, ["c", "c", "b"]), (4, ["zzz"])], "doc_id int, tokens array<string>"
    )
    found = {r.doc_id: r.vector for r in e.document_vectors(documents, table).collect()}
    assert found[1] == [0.5, 0.0] and found[2] == [0.0, 0.0] and found[4] == [0.0, 0.0]
    assert found[3] == pytest.approx([2 / 3, 1.0])


@pytest.mark.parametrize("dimension, block_bytes", [(300, 64 << 20), (300, 5_000), (3, 10)])
def test_document_vectors_equal_plain_sums(spark, monkeypatch, dimension, block_bytes):
    """In one block of words or in many; repeated and null ids, null tokens, unknown words."""
    monkeypatch.setattr(e, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(e, "MULTIPLIED", 7)
    monkeypatch.setattr(e, "COUNTED_TOKENS", 100)
    dice = np.random.default_rng(5)
    known = {f"w{i}": dice.normal(size=dimension) for i in range(40)}
    texts = [[f"w{i}" for i in dice.integers(0, 55, dice.integers(0, 30))] for _ in range(60)]
    rows = [*enumerate(texts), (7, texts[3]), (None, ["w1", None, "w2"]), (None, ["w1"]), (100, None), (101, [])]
    table = spark.createDataFrame([(w, v.tolist()) for w, v in known.items()], "word string, vector array<double>").repartition(3)
    documents = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(4)
    sums, sizes = {}, {}
    for doc, tokens in rows:
        sums[doc] = sums.get(doc, 0) + sum((known[w] for w in tokens or [] if w in known), np.zeros(dimension))
        sizes[doc] = sizes.get(doc, 0) + max(1, len(tokens or []))
    found = {r.doc_id: r.vector for r in e.document_vectors(documents, table).collect()}
    assert found.keys() == sums.keys()
    assert all(found[d] == pytest.approx(sums[d] / sizes[d], abs=1e-12) for d in sums)
    nothing = e.document_vectors(documents, table.limit(0)).collect()
    assert len(nothing) == len(sums) and all(r.vector == [] for r in nothing)
    assert e.document_vectors(documents.limit(0), table).count() == 0


def test_document_vectors_where_a_word_comes_twice(spark, monkeypatch):
    """Repeated rows of a word count once, however they reach a task; vectors are not copied for every slice."""
    monkeypatch.setattr(e, "MET_TOKENS", 20)
    known = {f"w{i}": [float(i), 1.0 / (i + 3)] for i in range(30)}
    table = spark.createDataFrame([*known.items()] * 2, "word string, vector array<double>").repartition(5)
    rows = [(i, [f"w{j % 33}" for j in range(i, 3 * i)]) for i in range(1, 15)]
    documents = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>").repartition(4)
    made = e.document_vectors(documents, table)
    found = {r.doc_id: r.vector for r in made.collect()}
    assert all(found[d] == pytest.approx(sum((np.array(known.get(w, [0, 0])) for w in tokens)) / len(tokens)) for d, tokens in rows)
    assert "explode([0" not in plan(made)


def test_distances_go_through_the_join_and_not_vectors(plain, table):
    words = plain.createDataFrame([(w,) for w in "abcdz"], "word string")
    odd = table.union(plain.createDataFrame([("z", None)], table.schema))
    found = e.nearest_euclid(words, odd, "a")
    assert [(r.word, round(r.distance, 6)) for r in found.collect()] == [("a", 0.0), ("c", 1.0), ("z", 1.0), ("b", 1.414214), ("d", 2.0)]
    steps = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    steps = [s for s in steps if not s.lstrip().startswith(":")]  # without subqueries
    above = steps[: next(i for i, s in enumerate(steps) if "Join LeftOuter" in s)]
    assert above and not any("zip_with" in s or "vector#" in s for s in above)


@pytest.fixture(scope="module")
def many(spark):
    """Random vectors where each comes twice, so that many similarities are equal."""
    dice = np.random.default_rng(3)
    vectors = np.repeat(dice.normal(size=(300, 8)), 2, axis=0)
    vectors[10:14] = 0
    rows = [(f"w{i:03d}", list(map(float, x))) for i, x in enumerate(vectors)]
    queries = [(i, list(map(float, x))) for i, x in enumerate(dice.normal(size=(25, 8)))]
    queries.append((25, [0.0] * 8))
    table = spark.createDataFrame(rows, "word string, vector array<double>").repartition(5)
    return table, spark.createDataFrame(queries, "query_id bigint, vector array<double>"), rows, queries


def brute_force(rows, queries, n):
    found = []
    for q, aim in queries:
        scored = []
        for word, x in rows:
            lengths = math.dist(x, [0] * 8) * math.dist(aim, [0] * 8)
            scored.append((-round(sum(map(lambda p: p[0] * p[1], zip(x, aim))) / lengths, 9) if lengths else 0.0, word))
        found += [(q, i + 1, word) for i, (_, word) in enumerate(sorted(scored)[:n])]
    return found


@pytest.mark.parametrize("block, tile", [(2048, 1 << 21), (7, 150)])
def test_many_queries(many, block, tile, monkeypatch):
    """In one block or in many, and in tiles of any size, the result is exact."""
    monkeypatch.setattr(e, "SLICE_WORDS", 100)
    monkeypatch.setattr(e, "BLOCK_QUERIES", block)
    monkeypatch.setattr(e, "TILE", tile)
    table, queries, rows, plain_queries = many
    found = e.similar_words(queries, table, 7)
    got = sorted((r.query_id, r.place, r.word) for r in found.collect())
    assert got == brute_force(rows, plain_queries, 7)


def test_nearest_words_need_no_full_sort(table):
    text = plan(e.synonyms(table, e.word_vector(table, "a"), 2))
    assert "TakeOrderedAndProject" in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_block_of_queries_stays_small():
    """2,048 queries on 20,000 words never hold all their similarities."""
    dice = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(20_000)])
    tracemalloc.start()
    found = e._best_per_query(np.arange(2_048), dice.normal(size=(2_048, 8)), words, dice.normal(size=(20_000, 8)), 5)
    assert len(found) == 5 * 2_048 and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_training(spark):
    tokens = spark.createDataFrame([(["a", "b", "c"],)] * 5 + [(["rare"],)] * 4, "tokens array<string>")
    model = e.train_word_vectors(tokens, 6, 3, 1, partitions=2)
    found = e.vector_table(model).collect()
    assert {r.word for r in found} == {"a", "b", "c"} == {r.word for r in e.vocabulary(model).collect()}
    assert all(len(r.vector) == 6 for r in found)


def test_words_of_one_topic_are_near_each_other(spark):
    """Trained vectors say something: of two topics that never meet, each word's nearest are its own."""
    dice = np.random.default_rng(2)
    topics = [[f"{t}{i}" for i in range(8)] for t in "ab"]
    rows = [([str(w) for w in dice.choice(topics[i % 2], 12)],) for i in range(600)]
    model = e.train_word_vectors(spark.createDataFrame(rows, "tokens array<string>").repartition(1), 12, 4, 12, partitions=1, seed=3)
    known = e.vector_table(model).cache()
    asked = spark.createDataFrame([(0, "a0"), (1, "b3"), (2, "a1 + a2"), (3, "b1 + b2 + b0")], "query_id bigint, expr string")
    found = e.word_query(asked, known, 6).collect()
    assert len(found) == 24
    assert all(r.word[0] == "abab"[r.query_id] for r in found)
    assert all(math.isfinite(x) for r in known.collect() for x in r.vector)
    known.unpersist()
