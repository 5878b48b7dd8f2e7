"""Benchmark decontamination against brute force, on odd inputs."""

import hashlib
import re

import pytest

from marginalia.llm import decontamination as deco

SCHEMA = "doc_id long, text string, n_chars long, _words string, item_id long"
ITEMS = "item_id long, text string, doc_id string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def by_hand(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for i in range(len(w)):
            for size in sizes:
                key = tuple(w[i : i + size])
                if len(key) == size and key in windows:
                    hit |= set(range(i, i + size))
                    met |= windows[key]
        ids = sorted(str(x) for x in met if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


LONG = "the quick brown fox jumps over the lazy dog while seven other foxes sleep near a river"
ITEM_ROWS = [(1, LONG), (20, LONG), (3, "Four words, no more"), (4, None), (5, ""), (6, "... !"), (None, "nameless item of five words"), (3, "one"), (7, "été à l'école 42 日本語 x y z w v u t"), (1, LONG), (9, "a " * 30)]
DOC_ROWS = [
    (1, f"Before. {LONG.upper()}, after"),
    (2, "the quick brown fox jumps over the lazy dog, while; seven-other foxes"),
    (3, "the quick brown fox jumps over the lazy dog"),
    (4, "so four_words no MORE four words no"),
    (5, None), (6, ""), (7, " \n\t!"), (None, LONG), (8, LONG), (8, LONG),
    (9, "ÉTÉ à l'école 42 日本語 x y z w v u t été à l'école 42 日本語 x y z w v u t"),
    (10, "nameless   item of five words"), (11, "one"), (12, "a " * 25), (13, f"{LONG} {LONG[:40]} " * 400), (14, "clean words only here"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, len(t or ""), "w", 7) for i, t in DOC_ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "d") for i, t in ITEM_ROWS], ITEMS).repartition(2)


def test_contamination_equals_brute_force(docs, items, scratch):
    got = sorted((tuple(r) for r in deco.contamination(docs, items, scratch).collect()), key=repr)
    assert got == by_hand(DOC_ROWS, ITEM_ROWS)


def test_many_blocks_and_short_pieces_find_the_same(docs, items, scratch, monkeypatch):
    monkeypatch.setattr(deco, "PIECE_WORDS", 3)
    monkeypatch.setattr(deco, "SCAN_WORDS", 7)
    found = deco.find_leaks(docs, items, scratch, block_bytes=150).select("doc_id", "_words", deco.n_hit(deco.F.col("_runs")), deco.F.size("_items"), deco.F.array_join("_items", ","))
    got = [(r[0], r[1], r[2], r[3], hashlib.sha256(r[4].encode()).hexdigest(), r[2] > 0) for r in found.collect()]
    assert sorted(got, key=repr) == by_hand(DOC_ROWS, ITEM_ROWS)


def test_the_scan_shuffles_nothing(docs, items, scratch):
    plan = deco.contamination(docs.select("doc_id", "text"), items, scratch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "RoundRobin" in plan  # the fixture's own repartition


def test_spans_and_documents_are_removed(docs, items, scratch):
    cut = deco.without_leaks(docs, items, scratch)
    assert cut.dtypes == docs.dtypes and cut.count() == len(DOC_ROWS)
    texts = {r.doc_id: r for r in cut.collect()}
    assert texts[1].text == "Before. , after" and texts[1].n_chars == len("Before. , after") and texts[1]._words == "w"
    assert texts[4].text == "so four_words no MORE four words no".replace("four_words no MORE", "")
    assert texts[5].text is None and texts[9].text == "ÉTÉ " and texts[14].text == DOC_ROWS[-1][1]
    kept = deco.without_leaks(docs, items, scratch, whole=True)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 14]


def test_empty_tables(spark, docs, items, scratch):
    none, no_items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    assert deco.contamination(none, items, scratch).count() == 0
    assert not any(r.contaminated for r in deco.contamination(docs, no_items, scratch).collect())
    texts = {r.doc_id: r.text for r in deco.without_leaks(docs, no_items, scratch).collect()}
    assert texts[1] == DOC_ROWS[0][1]
