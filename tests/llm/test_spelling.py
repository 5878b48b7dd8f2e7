"""Spelling variants against brute force, on odd inputs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marginalia.llm import spelling as sp

SCHEMA = "doc_id long, text string, word string, n long, size int, key string, root string, best string"
WORDS = "word string, n long"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """One character inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def variants_by_hand(counts, times=2):
    forms, found = {}, {}
    for w, n in counts.items():
        around = [v for v in counts if near(w, v)]
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= times * n else None
        found[w] = (len(around), counts[forms[w]] if forms[w] else None)
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, *found[w]))
    return sorted(out)


def words_by_hand(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def vocabulary(seed, letters, longest, n):
    draw = random.Random(seed)
    found = {"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))): draw.randint(1, 40) for _ in range(n)}
    return found


def by_repr(rows):
    return sorted(map(tuple, rows), key=repr)


VOCABULARIES = {
    "dense": vocabulary(1, "ab", 7, 300),
    "letters": vocabulary(2, "aéz日🙂", 5, 400),
    "long": {"a" * 300: 50, "a" * 299: 20, "a" * 301: 9, "a" * 150 + "b" + "a" * 149: 4, "b" + "a" * 299: 2, "a" * 299 + "b": 1, "a": 3, "b": 7, "ab": 20},
    "prefix": {"common" * 4 + w: n for w, n in vocabulary(3, "abc", 4, 200).items()},
    "suffix": {w + "common" * 4: n for w, n in vocabulary(4, "abc", 4, 200).items()},
    "one": {"alone": 3},
    "ties": {"words": 3, "wordy": 6, "worda": 6, "word": 6, "xwords": 6},
}


@pytest.mark.parametrize("longest", [4000, 3])
@pytest.mark.parametrize("name", VOCABULARIES)
def test_variants_equal_brute_force(spark, scratch, name, longest):
    """Also with lists that are cut until they hold a single place."""
    found = spark.createDataFrame([*VOCABULARIES[name].items()], WORDS).repartition(3)
    assert by_repr(sp.spelling_variants(found, scratch, longest=longest).collect()) == by_repr(variants_by_hand(VOCABULARIES[name]))


def test_words_of_documents(spark, scratch):
    draw = random.Random(5)
    base = ["régime", "maison", "colour", "color", "maïson", "MAISON", "ÉCOLE", "école", "x", "four", "naïve", "naive", "a" * 4000]
    texts = [" ".join(draw.choice(base) for _ in range(draw.randint(0, 60))) for _ in range(120)]
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[4]), (200, None), (201, ""), (202, " \n\t 123 日本"), (203, "maison×maison÷colour_color-color"), (204, "régime " * 3000)]
    docs = spark.createDataFrame([(i, t, "w", 1, 2, "k", "r", "b") for i, t in rows], SCHEMA).repartition(3)
    counts = words_by_hand(rows)
    assert {r.word: r.n for r in sp.word_counts(docs).collect()} == counts
    found = sp.document_spellings(docs, scratch)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and [t for _, t in found.dtypes][3:] == ["bigint"] * 3
    assert by_repr(found.collect()) == by_repr(variants_by_hand(counts))


def test_no_words(spark, scratch):
    for rows in ([], [(1, None)], [(1, "a b c")]):
        docs = spark.createDataFrame([(i, t, "w", 1, 2, "k", "r", "b") for i, t in rows], SCHEMA)
        assert sp.document_spellings(docs, scratch).count() == 0


def test_dynamic_programming_finds_all_pairs():
    for seed in range(20):
        words = sorted(vocabulary(seed, "abc", 6, 60))
        data = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        long = np.array([len(w) for w in words])
        n = len(words)
        cut = n // 3  # two lists
        first, end = np.r_[np.zeros(cut, int), np.full(n - cut, cut)], np.r_[np.full(cut, cut), np.full(n - cut, n)]
        found = sorted(zip(*map(np.ndarray.tolist, sp.one_edit_apart(data, np.cumsum(long) - long, long, first, end)), strict=True))
        assert found == [(i, j) for i in range(n) for j in range(n) if (i < cut) == (j < cut) and near(words[i], words[j])]


def test_lists_are_short_and_hold_each_pair_once(spark, scratch):
    found = spark.createDataFrame([*VOCABULARIES["prefix"].items()], WORDS)
    lists = sp._lists(found, scratch, 10)
    sizes = lists.groupBy("size", "low", "high", "front", "back").count().collect()
    assert all(r["count"] <= 10 or r.high - r.low == 1 for r in sizes)
