"""The operators on documents against brute force, on odd inputs."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from marginalia.llm import bpe, hilbert, jaccard_join, packing, ranking, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, task string, runs int, part string, words string, quality string"


def prose(seed, words=120):
    random.seed(seed)
    return " ".join("".join(random.choice("abcdeéñ ß") for _ in range(random.randint(2, 9))).strip() or "x" for _ in range(words))


def odd_texts():
    base = prose(1)
    shared = prose(2, 60)
    words = base.split()
    near = " ".join([*words[:50], "changed", *words[51:]])
    far = " ".join(w if i % 6 else "other" for i, w in enumerate(words))
    return [
        base, base, near, far, None, "", "   \n\t ", "one two", "ONE  two", "one two three four five", shared + " " + prose(3), prose(4) + " " + shared,
        "aaaa " * 3000, "a" * 5000, "a" * 5001, prose(5, 9000), "<|endoftext|> don't  'll\u0000\n\u0000 x y 日本語 🙂🙂 12345", "z", near + " tail", prose(6, 8),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 3 else "en", "src0" if i % 2 else None, len(t or ""), "t", 1, "p", "w", "q") for i, t in enumerate(odd_texts())]
    rows.append(rows[2])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def repeats_by_hand(texts):
    seen, out = set(), {}
    for doc, text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(data[i : i + 100])
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("crowd", [1000, 1])
def test_repeats_equal_brute_force(docs, scratch, monkeypatch, crowd):
    """Also with every shared gram treated as crowded."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    want = repeats_by_hand(list(enumerate(odd_texts())))
    got = [tuple(r) for r in suffix_dedup.repeats_removed(docs, scratch).collect()]
    assert len(got) == docs.count()
    assert {r[0]: r for r in got} == want and all(r == want[r[0]] for r in got)


def test_repeats_of_passages_longer_than_the_first_bytes_sorted(spark, scratch):
    """Passages of 100 to 260 bytes in ever other surroundings: pieces share more than 128 bytes and then part."""
    random.seed(7)
    passages = ["".join(random.choices("abcdefgh \n\0é", k=random.randint(100, 260))) for _ in range(4)]
    texts = []
    for doc in range(60):
        text = ""
        for _ in range(random.randint(0, 8)):
            of = random.choice(passages)
            text += of[random.randrange(40) : len(of) - random.randrange(40)] + "".join(random.choices("abcdefgh", k=random.randint(0, 3)))
        texts.append((doc, text))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r) for r in suffix_dedup.repeats_removed(docs, scratch).collect()}
    assert got == repeats_by_hand(texts)


def test_repeats_of_nothing_and_texts(docs, nothing, scratch):
    assert suffix_dedup.repeats_removed(nothing, scratch).count() == 0
    left = suffix_dedup.without_repeats(docs, scratch)
    assert left.schema == docs.schema and left.count() == docs.count()
    by_id = {r.doc_id: r for r in left.collect()}
    assert by_id[0].text == odd_texts()[0] and by_id[1].text == "" and by_id[1].n_chars == 0
    assert by_id[4].text is None and by_id[7].text == "one two"


def test_transforms_merge_to_the_common_order():
    random.seed(3)
    strings = [bytes(random.choice(b"ab") for _ in range(random.randint(4, 30))) for _ in range(40)]
    shards = [strings[:13], strings[13:14], strings[14:]]
    lasts, suffixes = [], []
    for shard in shards:
        text = np.frombuffer(b"\0".join(shard) + b"\0", np.uint8)
        sizes = np.array([len(s) + 1 for s in shard])
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(text)) - 1
        order = suffix_dedup.suffix_order(text, left, 32)
        lasts.append(np.r_[np.uint8(0), text[:-1]][order])
        suffixes += [bytes(text[i : i + left[i]]) for i in order]
    rows, block, common = suffix_dedup.merge_transforms(lasts, 8)
    merged = [suffixes[r][:8] for r in rows]
    assert merged == sorted(merged) and all((x == y) == (b == c) for x, y, b, c in zip(merged, merged[1:], block, block[1:], strict=False))
    for i, suffix in enumerate(suffixes):
        most = max(h for h in range(0, 9, 2) if len(suffix) >= h and sum(s[:h] == suffix[:h] for s in suffixes) > 1)
        assert common[i] == most and (i in set(rows.tolist())) == (most == 8)
    string, place = suffix_dedup._places(lasts[0], np.array([len(s) + 1 for s in shards[0]]))
    assert [shards[0][s][p:] for s, p in zip(string, place, strict=True)] == suffixes[: len(string)]


def shingles_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components_by_hand(texts):
    sets = {d: shingles_by_hand(t) for d, t in texts}
    low = {d: d for d in sets}
    moved = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while moved:
        moved = False
        for a, b in links:
            least = min(low[a], low[b])
            moved |= low[a] != low[b]
            low[a] = low[b] = least
    return {d: (d, len(sets[d]), low[d]) for d in sets}


def test_similar_documents_equal_brute_force(docs, nothing, scratch):
    want = components_by_hand(list(enumerate(odd_texts())))
    got = [tuple(r) for r in jaccard_join.near_documents(docs, scratch).collect()]
    assert len(got) == len(want) and {r[0]: r for r in got} == want
    assert jaccard_join.near_documents(nothing, scratch).count() == 0


def test_near_copies_at_the_threshold(spark, scratch):
    """Random edits put many pairs close to the threshold, in all size bands."""
    random.seed(8)
    texts = []
    for size in (5, 6, 7, 8, 9, 12, 20, 33, 70, 140, 300):
        for _ in range(4):
            words = [str(random.randint(0, 10**6)) for _ in range(size)]
            texts.append(" ".join(words))
            for _ in range(6):
                copy = list(words)
                for _ in range(random.randint(0, max(1, size // 25))):
                    copy[random.randrange(len(copy))] = "x"
                if random.random() < 0.5:
                    copy = copy[: random.randint(int(0.7 * size) or 1, size)]
                texts.append(" ".join(copy))
    rows = list(enumerate(texts))
    got = jaccard_join.near_documents(spark.createDataFrame(rows, "doc_id long, text string"), scratch)
    assert {r[0]: tuple(r) for r in got.collect()} == components_by_hand(rows)


def test_signatures_keep_the_pigeonhole_promise():
    """Similar sets share one of the signatures they may use, whatever the band."""
    random = np.random.default_rng(5)
    for size in [*range(1, 40), 64, 65, 100, 128, 129, 257, 600]:
        for _ in range(20):
            one = np.unique(random.integers(0, 2**64, size, dtype=np.uint64))
            drop = random.integers(0, len(one) // 4 + 1)
            two = np.unique(np.r_[random.permutation(one)[drop:], random.integers(0, 2**64, random.integers(0, len(one) // 3 + 1), dtype=np.uint64)])
            common = len(np.intersect1d(one, two))
            if not len(two) or 100 * common < 75 * (len(one) + len(two) - common):
                continue
            shared = [
                set(jaccard_join.signatures(one, band, most)[0].tolist()) & set(jaccard_join.signatures(two, other, more)[0].tolist())
                for band, most in jaccard_join.bands(len(one))
                for other, more in jaccard_join.bands(len(two))
                if band == other
            ]
            assert any(shared)
            bits = [jaccard_join.sketch(x) for x in (one, two)]
            if len(bits[0]) == len(bits[1]):
                assert sum(bin(int(x) & (2**64 - 1)).count("1") for x in bits[0] ^ bits[1]) <= len(one) + len(two) - 2 * common


def test_shards_differ_by_one_row(docs, nothing, scratch):
    rows = hilbert.document_shards(docs, scratch, shards=4).collect()
    texts = odd_texts()
    by_shard = defaultdict(list)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        by_shard[r.shard].append(r)
    assert sorted(len(x) for x in by_shard.values()) in ([5, 5, 5, 6],)
    for shard in by_shard.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in rows)
    assert hilbert.document_shards(nothing, scratch).count() == 0
    few = hilbert.document_shards(docs.limit(2), scratch).collect()
    assert sorted(r.shard for r in few) == [0, 1] and {r.slot for r in few} == {0}


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert.curve_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_packing_loses_no_token(docs, nothing):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path, texts = public_tokenizers.path("byte_bpe_50k.json"), odd_texts()
    ids = [np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.packed(docs.dropDuplicates(["doc_id"]), path, public_tokenizers.PATTERN).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(range(len(texts)))
    for doc, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            part = ids[doc][at : at + r.length]
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part.tobytes()), len(ids[doc]))
            at += r.length
        assert at == len(ids[doc])
    padding = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 1024 * docs.rdd.getNumPartitions()
    assert packing.packed(nothing, path, public_tokenizers.PATTERN).count() == 0
    assert packing.packed(docs, path, public_tokenizers.PATTERN).filter("doc_id = 2 AND start = 0").count() == 2


def test_step_groups_hold_equal_numbers_of_tokens(spark):
    rows = [(i, prose(i, 20 + 37 * (i % 40))) for i in range(400)]
    made = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    tokens, lengths = defaultdict(int), defaultdict(set)
    for r in made.select("step_group", "sequence_id", "sequence_length").distinct().collect():
        tokens[r.step_group] += r.sequence_length
        lengths[r.step_group].add(r.sequence_length)
    assert all(len(x) == 1 for x in lengths.values())
    assert sum(t == packing.STEP_TOKENS for t in tokens.values()) >= len(tokens) - 14 and max(tokens.values()) == packing.STEP_TOKENS


def test_words_encode_as_whole_texts(docs, nothing, scratch):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.document_tokens(docs, path, public_tokenizers.PATTERN, scratch).collect()
    assert len(got) == docs.count()
    for r in got:
        text = odd_texts()[r.doc_id] or ""
        ids = plain.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.document_tokens(nothing, path, public_tokenizers.PATTERN, scratch).count() == 0
    few = bpe.encode_documents(docs.select("doc_id", "text").filter("doc_id in (4, 16)"), path, public_tokenizers.PATTERN, scratch, run_bytes=1)
    found = {r.doc_id: r for r in few.collect()}
    assert found[4].ids == [] and bytes(found[16].decoded) == odd_texts()[16].encode()


def test_quality_is_learned_and_told_for_every_row(spark, docs, nothing):
    rows = [(i, prose(i, 60) if i % 4 else prose(i, 60).upper().replace(" ", "!! ")) for i in range(400)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 400)] + [(7, None, 1), (None, 1, 0), (8, 5, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in ranking.quality_scores(texts, labels).collect()}
    assert len(found) == 400
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) == int(i % 4 > 0)
    assert ranking.keep_good(texts, labels).count() == 300
    share = ranking.quality_scores(texts, labels, threshold=None, share=0.5).filter("predicted = 1").count()
    assert 195 <= share <= 205
    odd = ranking.quality_scores(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert ranking.quality_scores(nothing, labels).count() == 0
    assert ranking.quality_scores(docs, labels.limit(0)).count() == docs.count()
