"""The operators on vectors, pages and conversations against brute force, on odd inputs."""

import numpy as np
import pytest

from marginalia.llm import near_vectors, quotations, topk_search, warc


@pytest.fixture(scope="module")
def vectors(spark):
    random = np.random.default_rng(2)
    rows = []
    for i in range(300):
        v = random.normal(size=16) if i % 3 or not i else np.array(rows[i // 2][1][:16]) + random.normal(size=16) * 0.01
        rows.append((i, [float(np.float32(x)) for x in v], i % 4 if i % 7 else None, "x", 1.0))
    rows += [
        (300, None, 1, "x", 1.0), (301, [1.0, None], 1, "x", 1.0), (302, [float("nan")] * 16, 1, "x", 1.0), (303, [float("inf"), 1.0], 1, "x", 1.0),
        (304, [0.0] * 16, 1, "x", 1.0), (305, [], 1, "x", 1.0), (306, rows[1][1], 1, "x", 1.0), (307, rows[1][1], 1, "x", 1.0), (350, [1.0, 2.0], 2, "x", 1.0),
    ]
    rows.append(rows[5])
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, norm string, score double")


def good(row):
    return row.embedding is not None and all(x is not None and np.isfinite(x) for x in row.embedding)


def test_top_products_equal_brute_force(vectors, scratch):
    rows = {r.vec_id: [int(np.floor(256 * float(x))) for x in r.embedding] for r in vectors.collect() if good(r)}

    def product(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    want = set()
    for q in (i for i in rows if i % 50 == 0):
        best = sorted((-product(rows[q], v), i) for i, v in rows.items() if i != q)[:5]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    got = topk_search.embedding_search(vectors, scratch)
    assert {tuple(r) for r in got.collect()} == want
    several = topk_search.embedding_search(vectors.filter("vec_id % 50 = 0 OR vec_id < 3"), scratch, k=20)
    assert several.filter("query_id = 0").count() == vectors.filter("(vec_id % 50 = 0 OR vec_id < 3) AND vec_id not in (0, 300)").count()
    assert topk_search.embedding_search(vectors.limit(0), scratch).count() == 0


def test_query_blocks_do_not_matter(vectors, scratch):
    rows = vectors.filter("embedding is not null and size(embedding) = 16 and vec_id < 300").selectExpr(
        "vec_id", "transform(embedding, x -> cast(floor(100 * x) as bigint)) as vector"
    )
    one, many = (topk_search.top_products(rows, rows.vec_id % 10 == 0, scratch, 3, block) for block in (4096, 4))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


@pytest.mark.parametrize("tile", [4096, 16])
def test_near_vectors_link_as_their_cosines_say(vectors, scratch, monkeypatch, tile):
    monkeypatch.setattr(near_vectors, "TILE_ROWS", tile)
    rows = {r.vec_id: r for r in vectors.collect()}
    usable = [r for r in rows.values() if good(r) and r.label is not None and any(r.embedding)]
    unit = {r.vec_id: np.pad(np.array(r.embedding), (0, 16 - len(r.embedding))) / np.linalg.norm(r.embedding) for r in usable}
    links = [(a.vec_id, b.vec_id) for a in usable for b in usable if a.vec_id < b.vec_id and a.label == b.label and unit[a.vec_id] @ unit[b.vec_id] >= 0.98]
    low, count = {i: i for i in rows}, dict.fromkeys(rows, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    for _ in range(len(rows)):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    got = {r.vec_id: r for r in near_vectors.near_embeddings(vectors, scratch).collect()}
    assert set(got) == set(rows) and len(links) > 20
    assert all(got[i].n_links <= count[i] for i in rows)
    assert sum(r.n_links for r in got.values()) >= 0.95 * 2 * len(links)
    exact = [i for i in rows if got[i].component_id == low[i]]
    assert len(exact) >= 0.95 * len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert got[306].n_links == got[307].n_links >= 1 and got[306].component_id == got[1].component_id or rows[1].label != 1
    assert near_vectors.near_embeddings(vectors.limit(0), scratch).count() == 0
    assert near_vectors.near_embeddings(vectors.filter("vec_id in (300, 304)"), scratch).filter("kept and n_links = 0").count() == 2


PAGES = "page_id long, url string, html string, file string, block long"


def test_archives_give_every_page_back(spark, scratch):
    trap = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: {}\r\n\r\nxx\r\n\r\n"
    html = [
        "<p>one</p>", "<p>one</p>", None, "", "é" * 3000, trap.format(2), "a" + trap.format(10**6) + "b" + trap.format(3), "WARC/1.0\r\n" * 50,
        "x" * 400_000, "\r\n\r\n", trap.format("zz"), "<p>one</p>",
    ]
    rows = [(i, None if i == 3 else f"http://x/{i}\r\n", h, "f", 1) for i, h in enumerate(html)]
    rows.append((None, "u", "lost", "f", 1))
    got = {r.page_id: r for r in warc.archive_pages(spark.createDataFrame(rows, PAGES).repartition(3), scratch).collect()}
    assert set(got) == set(range(len(html)))
    for i, h in enumerate(html):
        data = (h or "").encode()
        same = [j for j, x in enumerate(html) if (x or "") == (h or "")]
        revisit = i != max(same)
        want = (i, len(data), warc.base32_sha1(data), "revisit" if revisit else "response", max(same) if revisit else None)
        assert (i, got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == want
    assert warc.archive_pages(spark.createDataFrame([], PAGES), scratch).count() == 0


def test_offsets_hold_over_splits(spark, scratch):
    """An uncompressed archive that is read in many splits keeps its chain."""
    path = scratch.file("plain")
    records = [warc._record(i, "u", None, "D", (f"body {i} WARC/1.0\r\n" * (i % 5)).encode()).decode() for i in range(200)]
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = warc.read_warc(spark, path, scratch)
        assert sorted(r.page_id for r in got.collect()) == list(range(200))
        assert got.filter("payload_digest is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_open_payloads_are_followed_over_splits(spark, scratch):
    """Payloads that hold the mark many times and run on into one or several later splits."""
    path = scratch.file("plain")
    bodies = [f"body {i} WARC/1.0\r\n" * (400 if i % 20 == 0 else i % 8) for i in range(100)]
    records = [warc._record(i, "u", None, "D", b.encode()).decode() for i, b in enumerate(bodies)]
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = {r.page_id: (r.payload_bytes, r.payload_digest) for r in warc.read_warc(spark, path, scratch).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: (len(b), warc.base32_sha1(b.encode())) for i, b in enumerate(bodies)}


def test_payloads_that_end_early_are_an_error(spark, scratch):
    path = scratch.file("plain")
    record = warc._record(1, "u", None, "D", b"all of it").decode()[:-4]
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="of 9 bytes of the record at 0"):
        warc.read_warc(spark, path, scratch).collect()


def test_quotes_lead_to_their_messages(spark, scratch):
    rows = [
        (1, 0, "a", "Hello there\nhow are you"),
        (1, 1, "b", "> hello   THERE\n> how are you\n\nfine"),
        (1, 2, "a", ">> Hello there\n>> how are you\n> fine\nglad"),
        (1, 3, "c", "> unknown\nnobody said that"),
        (1, 4, "b", "> Hello there\n> how are you\nlate answer"),
        (1, 5, None, None), (1, 6, "a", "> > deep only"), (1, 7, "a", "fine"), (1, 8, "b", "> fine\nto the later one"),
        (1, 8, "z", "a second row of that turn"), (2, 0, "a", "> fine\nother conversation"), (None, 1, "a", "x"), (3, None, "a", "x"),
        (4, 0, "a", ("> " + "word " * 20_000 + "\n") * 3), (1, 4, "b", "> Hello there\n> how are you\nlate answer"),
    ]
    messages = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, hash string")
    got = {(r.conv_id, r.turn): r for r in quotations.link_quotations(messages.select("conv_id", "turn", "role", "text"), scratch).collect()}
    assert len(got) == 11
    parents = {k: r.parent_turn for k, r in got.items() if r.parent_turn is not None}
    assert parents == {(1, 1): 0, (1, 2): 1, (1, 4): 0, (1, 8): 7}
    assert [(got[1, t].root_turn, got[1, t].depth) for t in (0, 1, 2, 4, 8)] == [(0, 0), (0, 1), (0, 2), (0, 1), (7, 1)]
    assert got[1, 2].text == "glad" and (got[1, 2].n_quotes, got[1, 2].n_linked) == (2, 2) and got[1, 5].text == ""
    assert quotations.link_quotations(quotations.mail(messages.limit(0)), scratch).count() == 0
    assert quotations.link_quotations(quotations.mail(messages), scratch).count() == 11


def test_parts_of_messages_are_quoted(spark, scratch):
    """Single paragraphs, single lines, some lines of a paragraph, and answers below each in turn."""
    first = "Where do we meet?\n\nBring the map\nand a lamp\nand two ropes\n\nSee you"
    rows = [
        (1, 0, "a", first), (1, 1, "b", "See you\nsoon, says another line"),
        (1, 2, "c", "> Bring the MAP\n> and a lamp\n> and two ropes\n\none paragraph"),
        (1, 3, "d", "> and a  lamp\none line"),
        (1, 4, "e", "> and a lamp\n> and two ropes\n> See you\nsome lines, the longest decides"),
        (1, 5, "f", "> Where do we meet?\nhere\n\n> Bring the map\n> and a lamp\n> and two ropes\nyes\n>> said by none\n> See you\nbye"),
        (1, 6, "g", "> > Where do we meet?\n> here\nan inline answer"), (1, 7, "h", "> soon\nonly a part of a line"),
        (1, 8, "i", "Bring the map\r\n\r\nand more\r\nto come\r"), (1, 9, "j", "> and more\r\n> to come\r\nends of lines"),
        (1, 10, "k", "See you"), (1, 11, "l", "and so on\nSee you"), (1, 12, "m", "> See you\nthe one that says just that"),
    ]
    got = {r.turn: r for r in quotations.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), scratch).collect()}
    parents = {t: r.parent_turn for t, r in got.items() if r.parent_turn is not None}
    assert parents == {2: 0, 3: 0, 4: 0, 5: 0, 6: 5, 9: 8, 12: 10}
    assert {t: (r.n_quotes, r.n_linked) for t, r in got.items() if r.n_quotes} == {
        2: (1, 1), 3: (1, 1), 4: (1, 1), 5: (4, 3), 6: (2, 2), 7: (1, 0), 9: (1, 1), 12: (1, 1)
    }
    assert got[5].text == "here\nyes\nbye" and (got[6].root_turn, got[6].depth) == (0, 2)


def test_messages_of_one_turn_stay_apart(spark, scratch):
    rows = [(1, 0, "a", "one"), (1, 0, "b", "two"), (1, 0, "b", "two"), (1, 0, None, None), (1, 1, "a", "> two\nleft"), (1, 1, "a", "> one\nright"), (1, 2, "b", "> left\nend")]
    got = quotations.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), scratch, apart=True).collect()
    assert sorted((r.turn, r.role or "", r.text, r.parent_turn, r.depth) for r in got) == [
        (0, "", "", None, 0), (0, "a", "one", None, 0), (0, "b", "two", None, 0), (1, "a", "left", 0, 1), (1, "a", "right", 0, 1), (2, "b", "end", 1, 2),
    ]


def test_long_threads_and_far_quotes(spark, scratch, monkeypatch):
    """A chain of replies, and quotes of a passage said in an earlier block of turns."""
    monkeypatch.setattr(quotations, "TURNS_PER_BLOCK", 8)
    chain = [(1, t, "a", (f"> line {t - 1}\n" if t else "") + f"line {t}") for t in range(60)]
    far = [(2, 0, "a", "start"), *[(2, t, "b", f"> start\nanswer {t}") for t in range(1, 40)]]
    got = quotations.link_quotations(spark.createDataFrame(chain + far, "conv_id long, turn long, role string, text string"), scratch).collect()
    assert all((r.root_turn, r.depth) == (0, r.turn if r.conv_id == 1 else min(r.turn, 1)) for r in got)
