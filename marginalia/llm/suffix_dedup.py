"""Repeated substrings by merging Burrows-Wheeler transforms of shards
(after Holt and McMillan, Merging of multi-string BWTs with applications, 2014, and Egidi and
others, who read common prefixes off the rounds of the merge).

Equal strings of ``length`` bytes hold the same smallest hash of ``GRAM`` bytes at the same place.
The texts are cut into segments: the runs of windows with one such place. Windows that are equal
lie in segments of one smallest hash, so only segments that share it are looked at together.
Segments that are equal as a whole are settled by their hash: the earliest stays, in the others
every window repeats. What is left, mostly the edges of repeats, is brought into order:

1. every shard of a bucket of segments is sorted on its own and gives its transform;
2. the transforms of a bucket are merged. A round turns the interleave of the shards' suffixes by
   their first h bytes into that by their first h + 2: each suffix hands its place on to the one two
   bytes before it. No suffix is compared with another one. Where the interleave breaks in a
   round, the common prefix of two neighbours ends;
3. after ``length`` bytes the unbroken stretches are the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import as_bytes, mix, ragged, slices
from marginalia.llm.tables import pick, shuffle_width
from marginalia.scratch import Scratch

LENGTH = 100
GRAM = 32
SLICE = 1 << 19
SHARDS = 4
BUCKET_BYTES = 400_000
CROWD = 1000
RUNS = "_covered_windows"

COVERED, EDGE, CROWDED = 1, 2, 3
CUT = "gram long, content long, doc_id long, start long"
SETTLED = "gram long, doc_id long, start long, windows int, kind int"
TRANSFORM = "bucket long, shard int, last binary, sizes binary, docs binary, starts binary"


class Hashes:
    """Hashes of any stretch of some bytes, from prefix sums."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, data: np.ndarray, seed: int):
        base = (self.BASE + 2 * seed) % 2**64
        steps = np.full(len(data) + 1, base, np.uint64)
        steps[0] = 1
        up = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = pow(base, -1, 2**64)
        self.down = np.cumprod(steps, dtype=np.uint64)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(mix(np.arange(256), 50 + seed)[data] * up[:-1], dtype=np.uint64, out=self.sums[1:])

    def of(self, first, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.down[first])


def segments(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``text, start, windows, gram, content``: the runs of windows that share their smallest gram.

    ``start`` counts from the start of the text. Which gram is smallest, the first of equal ones,
    depends on the window alone.
    """
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if len(data) < length:
        return none
    grams, span = len(data) - GRAM + 1, length - GRAM + 1
    hashes = Hashes(data, 0)
    every = np.arange(grams, dtype=np.int64)
    gram = hashes.of(slice(0, grams), slice(GRAM, GRAM + grams))
    low = np.uint64((1 << 24) - 1)  # a slice of text is shorter than that, or one long text
    wide = len(data) > 1 << 24
    least = (gram & ~low) | (every.astype(np.uint64) & low)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    windows = len(data) - length + 1
    least = np.minimum(least[:windows], least[span - size : span - size + windows])
    where = (least & low).astype(np.int64)
    if wide:  # places count from the window then
        where += (every[:windows] - where + (1 << 24) - 1 >> 24) << 24
    room = at[1:] - at[:-1] - length + 1  # windows of each text
    fits = np.flatnonzero(room > 0)
    inside = ragged(at[fits], room[fits])
    owner = np.repeat(fits, room[fits])
    here = where[inside]
    first = np.flatnonzero(np.r_[True, (here[1:] != here[:-1]) | (owner[1:] != owner[:-1])][: len(here)])
    if not len(first):
        return none
    count = np.diff(np.r_[first, len(here)])
    begin = inside[first]
    content = hashes.of(begin, begin + count + length - 1) + count.astype(np.uint64)
    return owner[first], begin - at[owner[first]], count, gram[here[first]], content


def _cut(length: int):
    """Documents to segments. Of equal ones in a slice the first goes on; the windows of the
    others are covered, in runs as long as possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            ids = part.column("doc_id").to_numpy()
            by_id = np.argsort(ids, kind="stable")
            part = part.take(pa.array(by_id))
            ids = ids[by_id]
            text, start, windows, gram, content = segments(*as_bytes(part.column("text")), length)
            doc = ids[text]
            order = np.lexsort((start, doc, content, gram))
            same = np.r_[False, (gram[order][1:] == gram[order][:-1]) & (content[order][1:] == content[order][:-1])][: len(order)]
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            later = same & ((doc[order] != doc[order][head]) | (start[order] != start[order][head]))
            first, covered = order[~same], np.sort(order[later])
            # Covered segments that follow one another become one.
            joins = np.r_[False, (text[covered][1:] == text[covered][:-1]) & (start[covered][1:] == (start + windows)[covered][:-1])][: len(covered)]
            heads = covered[~joins]
            total = np.add.reduceat(windows[covered], np.flatnonzero(~joins)) if len(covered) else np.zeros(0, np.int64)
            spread = mix(doc[heads].astype(np.uint64) ^ mix(start[heads]))
            # The last byte of the content tells the number of windows; 0 marks a covered run.
            told = (content[first] << np.uint64(8)) | windows[first].astype(np.uint64)
            columns = [
                np.r_[gram[first], spread].view(np.int64), np.r_[told, total.astype(np.uint64) << np.uint64(8)].view(np.int64),
                np.r_[doc[first], doc[heads]].astype(np.int64), np.r_[start[first], start[heads]].astype(np.int64),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "content", "doc_id", "start"])

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in the order of gram, content, document and start to what becomes of them.

    Of equal segments all but the earliest are covered. Earliest ones go on as edges if other
    segments share their gram; where more than ``CROWD`` do, a row says so for the gram. Only
    one segment is held back between batches.
    """
    names = [c.split()[0] for c in SETTLED.split(", ")]
    last, waiting, crowd = None, None, 0  # last: gram, content, doc, start of the earliest
    for batch in batches:
        windows = batch.column("content").to_numpy() & 255
        through = batch.filter(pa.array(windows == 0))
        total = (through.column("content").to_numpy() >> 8).astype(np.int32)
        known = [through.column(c) for c in ("gram", "doc_id", "start")]
        yield pa.RecordBatch.from_arrays([*known, pa.array(total), pa.array(np.full(len(total), COVERED, np.int32))], names)
        rows = batch.filter(pa.array(windows > 0))
        if not rows.num_rows:
            continue
        gram, content, doc, start = (rows.column(c).to_numpy() for c in ("gram", "content", "doc_id", "start"))
        windows = (content & 255).astype(np.int32)
        new_gram = np.r_[last is None or gram[0] != last[0], gram[1:] != gram[:-1]]
        new = new_gram | np.r_[last is None or content[0] != last[1], content[1:] != content[:-1]]
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        head_doc = np.where(head >= 0, doc[head], last[2] if last else 0)
        head_start = np.where(head >= 0, start[head], last[3] if last else 0)
        covered = np.flatnonzero(~new & ((doc != head_doc) | (start != head_start)))
        firsts = np.flatnonzero(new)
        opens = new_gram[firsts]
        edge = ~opens | np.r_[~opens[1:], False][: len(opens)]
        # How many segments with this gram came before, counted over batches.
        group = np.cumsum(opens)
        begin = np.r_[0, np.flatnonzero(opens)]
        nth = np.arange(len(firsts)) - begin[group] + np.where(group == 0, crowd, 0)
        crowded = firsts[nth == CROWD]
        out = [(covered, COVERED), (firsts[edge], EDGE), (crowded, CROWDED)]
        if waiting is not None and len(firsts):
            if not opens[0]:
                yield pa.RecordBatch.from_arrays([pa.array([v]).cast(t) for v, t in zip(waiting, [pa.int64()] * 3 + [pa.int32()] * 2, strict=True)], names)
            waiting = None
        for some, what in out:
            if len(some):
                picked = [pa.array(c[some]) for c in (gram, doc, start, windows)]
                yield pa.RecordBatch.from_arrays([*picked, pa.array(np.full(len(some), what, np.int32))], names)
        if len(firsts):
            i = firsts[-1]
            if opens[-1]:
                waiting = (int(gram[i]), int(doc[i]), int(start[i]), int(windows[i]), EDGE)
            crowd = int(nth[-1]) + 1
            last = (gram[i], content[i], doc[i], start[i])


def _extract(length: int):
    """Edges, as rows of their document, to their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = as_bytes(batch.column("text"))
            edges = batch.column(RUNS)
            flat = edges.flatten()
            many = edges.value_lengths().fill_null(0).to_numpy()
            row = np.repeat(np.arange(batch.num_rows), many)
            start, windows = flat.field("start").to_numpy(), flat.field("windows").to_numpy().astype(np.int64)
            size = windows + length - 1
            joined = data[ragged(at[row] + start, size)]
            ends = np.r_[0, np.cumsum(size)].astype(np.int32)
            body = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(joined.tobytes())])
            doc = batch.column("doc_id").take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [flat.field("gram"), doc, flat.field("start"), flat.field("crowded"), body], ["gram", "doc_id", "start", "crowded", "body"]
            )

    return run


def suffix_order(text: np.ndarray, left: np.ndarray, reach: int) -> np.ndarray:
    """The suffixes of ``text`` by their first ``reach`` bytes or more; ``left`` bytes before the
    string's end are compared, and what is equal stays in the order it has."""
    n = len(text)
    padded = np.r_[text, np.zeros(8, np.uint8)]
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | np.where(left > i, padded[i : i + n], 0).astype(np.uint64)
    size, order = 8, np.argsort(key, kind="stable")
    while True:
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])
        if size >= reach:
            return order
        onward = np.minimum(np.arange(n) + size, n - 1)
        key = (rank << np.uint64(32)) | np.where(left > size, rank[onward] + np.uint64(1), 0)
        order = np.argsort(key, kind="stable")
        size *= 2


def _transform(length: int):
    """One shard's segments to the transform of their suffixes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start"], ignore_index=True)
        bodies = rows["body"].tolist()
        text = np.frombuffer(b"\0".join(b.replace(b"\0", b"\xc0") for b in bodies) + b"\0", np.uint8)  # \xc0 is never part of UTF-8
        sizes = np.array([len(b) + 1 for b in bodies], np.int64)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(text)) - 1
        order = suffix_order(text, left, int(sizes.max()))  # whole strings: ties would lead the way back astray
        before = np.r_[np.uint8(0), text[:-1]][order]  # the end mark of the string before stands for none
        return pd.DataFrame(
            {
                "bucket": [rows["bucket"].iloc[0]], "shard": [rows["shard"].iloc[0]], "last": [before.tobytes()],
                "sizes": [sizes.astype("<i4").tobytes()],
                "docs": [rows["doc_id"].to_numpy("<i8").tobytes()], "starts": [rows["start"].to_numpy("<i8").tobytes()],
            }
        )

    return run


def _back(last: np.ndarray) -> np.ndarray:
    """For each row of a transform the row of the suffix one byte longer, by counting bytes."""
    to = np.empty(len(last), np.int64)
    to[np.argsort(last, kind="stable")] = np.arange(len(last))
    return to


def merge_transforms(lasts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge transforms (0 marks a string's end): the rows whose first ``length`` bytes are shared,
    in order, the repeated interval of each, and for all rows how many bytes they share with some
    other one, to a multiple of two and up to ``length``.

    Rows of all shards are numbered through. ``length`` has to be even. An end mark differs from
    every other one. Suffixes that share ``h`` bytes share ``h - 2`` once two bytes are taken off,
    so a suffix that is alone with its prefix hands nothing on.
    """
    base = np.cumsum([0, *map(len, lasts)])[:-1]
    last = np.concatenate(lasts)
    one = np.concatenate([_back(x) + b for x, b in zip(lasts, base, strict=True)])
    has_two = (last > 0) & (last[one] > 0)
    two, pair = one[one], (last[one].astype(np.uint16) << 8) | last
    rows, block = np.arange(len(last)), np.zeros(len(last), np.int64)
    common = np.zeros(len(last), np.int64)
    for done in range(2, length + 1, 2):
        onward = has_two[rows]
        rows, block = rows[onward], block[onward]
        keys = pair[rows]
        order = np.argsort(keys, kind="stable")
        keys, came, rows = keys[order], block[order], two[rows[order]]
        breaks = np.r_[True, (keys[1:] != keys[:-1]) | (came[1:] != came[:-1])][: len(rows)]
        shared = ~breaks | np.r_[~breaks[1:], False][: len(rows)]
        rows, block = rows[shared], np.cumsum(breaks)[shared]
        common[rows] = done
        if not len(rows):
            break
    return rows, block, common


def _places(last: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row of a transform its string and its place there, going back from all ends at once."""
    back = _back(last)
    string, place = np.zeros(len(last), np.int64), np.zeros(len(last), np.int64)
    row, of, at = np.arange(len(sizes)), np.arange(len(sizes)), sizes - 1
    while len(row):
        string[row], place[row] = of, at
        more = last[row] > 0
        row, of, at = back[row[more]], of[more], at[more] - 1
    return string, place


def _merge(length: int):
    """The transforms of one bucket to the windows that repeat an earlier one."""

    def run(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard", ignore_index=True)
        lasts = [np.frombuffer(x, np.uint8) for x in shards["last"]]
        rows, interval, _ = merge_transforms(lasts, length)
        doc, start = [], []
        for last, sizes, docs, starts in zip(lasts, shards["sizes"], shards["docs"], shards["starts"], strict=True):
            string, place = _places(last, np.frombuffer(sizes, "<i4").astype(np.int64))
            doc.append(np.frombuffer(docs, "<i8")[string])
            start.append(np.frombuffer(starts, "<i8")[string] + place)
        doc, start = np.concatenate(doc)[rows], np.concatenate(start)[rows]
        order = np.lexsort((start, doc, interval))
        same = np.r_[False, interval[order][1:] == interval[order][:-1]][: len(order)]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        later = order[same & ((doc[order] != doc[order][head]) | (start[order] != start[order][head]))]
        later = later[np.lexsort((start[later], doc[later]))]
        doc, start = doc[later], start[later]
        first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)][: len(doc)])
        final = np.r_[first[1:], len(doc)][: len(first)] - 1
        return pd.DataFrame({"doc_id": doc[first], "start": start[first], "windows": (start[final] - start[first] + 1).astype(np.int32)})

    return run


def _windows(length: int, parts: int):
    """Crowded edges to the hashes of their windows, packed by part of the hash space: of each window
    two hashes, the document and the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", 1 << 19):
            data, at = as_bytes(batch.column("body"))
            count = np.diff(at) - length + 1
            row = np.repeat(np.arange(batch.num_rows), count)
            begin = ragged(at[:-1], count)
            one, two = (Hashes(data, seed).of(begin, begin + length) for seed in (1, 2))
            doc = batch.column("doc_id").to_numpy()[row]
            place = batch.column("start").to_numpy()[row] + begin - at[row]
            rows = np.stack([one.view(np.int64), two.view(np.int64), doc, place], axis=1)
            part = (one % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            rows, ends = rows[order], np.searchsorted(part[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(ends))
            packed = [rows[ends[p] : ends[p + 1]].tobytes() for p in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(packed, pa.binary())], ["part", "rows"])

    return run


def _same_windows(packed: pd.DataFrame) -> pd.DataFrame:
    """One part of the hash space to the windows that an earlier one equals."""
    one, two, doc, start = np.frombuffer(b"".join(packed["rows"]), np.int64).reshape(-1, 4).T
    order = np.lexsort((start, doc, two, one))
    one, two, doc, start = one[order], two[order], doc[order], start[order]
    same = np.r_[False, (one[1:] == one[:-1]) & (two[1:] == two[:-1])]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(one))))
    later = same & ((doc != doc[head]) | (start != start[head]))
    return pd.DataFrame({"doc_id": doc[later], "start": start[later], "windows": np.ones(int(later.sum()), np.int32)})


def _by_id(documents: DataFrame) -> DataFrame:
    """The documents dealt out by id. Extraction and removal both read this one shuffle, so it
    must be the same plan in both."""
    return documents.repartition(shuffle_width(documents), "doc_id")


def covered_windows(documents: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """``(doc_id, start, windows)``: runs of windows of ``length`` bytes in the texts of ``documents`` that also start
    earlier, in a smaller id or further left in the same text. Runs may overlap."""
    if length < 2 * GRAM or length % 2:
        raise ValueError(f"length must be even and at least {2 * GRAM}")
    known = pick(documents, doc_id="doc_id", text="text").filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))
    settled = (
        known.mapInArrow(_cut(length), CUT)
        .repartition(shuffle_width(documents), "gram")
        .sortWithinPartitions("gram", "content", "doc_id", "start")
        .mapInArrow(_settle, SETTLED)
    )
    settled = scratch.keep(settled, "settled")
    edges = settled.filter(F.col("kind") == EDGE)
    total = edges.agg(F.sum(F.col("windows") + length - 1)).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    crowded = settled.filter(F.col("kind") == CROWDED).select("gram", F.lit(True).alias("crowded"))
    one = F.struct("gram", "start", "windows", F.coalesce("crowded", F.lit(False)).alias("crowded"))
    of_doc = edges.join(crowded, "gram", "left").groupBy("doc_id").agg(F.collect_list(one).alias(RUNS))
    bodies = _by_id(documents).join(of_doc, "doc_id", "left").mapInArrow(
        _extract(length), "gram long, doc_id long, start long, crowded boolean, body binary"
    )
    shards = (
        bodies.filter("not crowded")
        .select(F.pmod("gram", F.lit(buckets)).cast("long").alias("bucket"), F.pmod(F.xxhash64("body"), F.lit(SHARDS)).cast("int").alias("shard"), "doc_id", "start", "body")
        .groupBy("bucket", "shard").applyInPandas(_transform(length), TRANSFORM)
    )
    merged = shards.groupBy("bucket").applyInPandas(_merge(length), "doc_id long, start long, windows int")
    each = bodies.filter("crowded").select("doc_id", "start", "body").mapInArrow(_windows(length, shuffle_width(documents)), "part long, rows binary")
    later = each.groupBy("part").applyInPandas(_same_windows, "doc_id long, start long, windows int")
    whole = settled.filter(F.col("kind") == COVERED).select("doc_id", "start", "windows")
    return whole.unionByName(merged).unionByName(later)


def _removed(length: int, keep_text: bool):
    """A document with its covered windows to what is left of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = as_bytes(batch.column("text"))
            runs = batch.column(RUNS)
            flat, many = runs.flatten(), runs.value_lengths().fill_null(0).to_numpy()
            ends = np.r_[0, np.cumsum(many)]
            starts, windows = flat.field("start").to_numpy(), flat.field("windows").to_numpy().astype(np.int64)
            removed, spans, left = [], [], []
            for i in range(batch.num_rows):
                body = data[at[i] : at[i + 1]]
                first, size = starts[ends[i] : ends[i + 1]], windows[ends[i] : ends[i + 1]] + length - 1
                depth = np.zeros(len(body) + 1, np.int32)
                np.add.at(depth, first, 1)
                np.add.at(depth, first + size, -1)
                gone = np.cumsum(depth[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.r_[False, gone[:-1]][: len(gone)]).sum()))
                left.append(body[~gone].tobytes())
            if keep_text:
                texts = pa.array([x.decode(errors="ignore") for x in left], pa.string())
                at_text, at_chars = batch.schema.get_field_index("text"), batch.schema.get_field_index("n_chars")
                touched = pa.array(np.array(removed) > 0)
                new = batch.set_column(at_text, "text", pa.compute.if_else(touched, texts, batch.column("text").cast(pa.string())))
                if at_chars >= 0:
                    chars = pa.array([len(t) for t in texts.to_pylist()], batch.column("n_chars").type)
                    new = new.set_column(at_chars, "n_chars", pa.compute.if_else(touched, chars, batch.column("n_chars")))
                yield new.drop_columns([RUNS])
            else:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(np.diff(at)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in left]),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return run


def _with_runs(documents: DataFrame, scratch: Scratch, length: int) -> DataFrame:
    runs = covered_windows(documents, scratch, length)
    of_doc = runs.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias(RUNS))
    return _by_id(documents).join(of_doc, "doc_id", "left").select(*documents.columns, RUNS)


def repeats_removed(documents: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``documents``.

    Every byte that lies in a string of ``length`` bytes which also starts earlier is removed; all
    is judged on the input. A null text is empty; texts shorter than ``length`` stay. A row with a
    null id stays whole and covers nothing. Rows with the same id and text are one document that is
    told of twice; with other texts under one id both are judged as if they began that document.
    """
    joined = _with_runs(pick(documents, doc_id="doc_id", text="text"), scratch, length)
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_removed(length, False), out)


def without_repeats(documents: DataFrame, scratch: Scratch, length: int = LENGTH) -> DataFrame:
    """The documents, all columns kept, with their repeats cut out of the text and ``n_chars`` anew.

    A character that loses one of its bytes is dropped. Untouched texts, null ones too, stay as they are.
    """
    joined = _with_runs(documents, scratch, length)
    return joined.mapInArrow(_removed(length, True), documents.schema)
