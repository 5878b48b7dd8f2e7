"""Benchmark decontamination: a broadcast hash set of normalised item windows, scanned by documents.

Words are maximal runs of ``0-9``, ``a-z`` and all characters from U+0080 on, after ``A-Z`` became
lower case. A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not of
none, is one window. A document's word is hit when it lies in any occurrence of a window.

The windows of a block of items go to all tasks as sorted hashes with the items' bytes, so a hit is
verified byte by byte. A block holds a bounded number of bytes (``BLOCK_BYTES``); a benchmark that is
larger takes several blocks, each a pass of its own over the documents and what was found before.
Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from marginalia.llm.batches import as_bytes, ragged, sequence_hashes, slices
from marginalia.llm.tables import pick
from marginalia.scratch import Scratch

WINDOW = 10

#: A long item is cut into pieces of so many words, which overlap by all but one word of a window.
PIECE_WORDS = 20_000
#: Bytes of normalised items in one broadcast. A task's hashes of them take about ten times as much.
BLOCK_BYTES = 8 << 20
#: Words that are hashed at a time.
SCAN_WORDS = 1 << 15

BLANK = 0x20
_CODES = np.arange(256)
_WORD = ((_CODES >= 0x30) & (_CODES <= 0x39)) | ((_CODES >= 0x41) & (_CODES <= 0x5A)) | ((_CODES >= 0x61) & (_CODES <= 0x7A)) | (_CODES >= 0x80)
#: The byte that stands for each byte: lower case of a letter, a blank for what is in no word.
NORMAL = np.where(_WORD, np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 0x20, _CODES), BLANK).astype(np.uint8)
#: Any other numbering of the bytes gives the hash of a window a second, independent half.
OTHER = ((_CODES * 167 + 13) & 255).astype(np.uint8)

PIECES = "item string, piece binary, size long"
RUNS = ArrayType(StructType([StructField("start", LongType()), StructField("stop", LongType())]))
_RUN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the bytes starts and ends."""
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    return edges[::2], edges[1::2]


def joined_words(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The given words in normal form with one blank behind each, and where they start and end there."""
    sizes = end - first + 1
    stop = np.cumsum(sizes)
    if not len(first):
        return np.zeros(0, np.uint8), stop, stop
    at = ragged(first, sizes)
    out = NORMAL[data[np.minimum(at, len(data) - 1)]]
    out[stop - 1] = BLANK
    return out, stop - sizes, stop - 1


def _item_pieces(window: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = as_bytes(batch.column("text"))
            names = batch.column("item").to_pylist()
            items, found = [], []
            for i, name in enumerate(names):
                text = data[at[i] : at[i + 1]]
                first, end = words_of(text)
                for w in range(0, max(1, len(first) - window + 1) if len(first) else 0, PIECE_WORDS):
                    last = min(len(first), w + PIECE_WORDS + window - 1)
                    items.append(name)
                    found.append(joined_words(text, first[w:last], end[w:last])[0].tobytes())
            yield pa.record_batch(
                [pa.array(items, pa.string()), pa.array(found, pa.binary()), pa.array(list(map(len, found)), pa.int64())],
                ["item", "piece", "size"],
            )

    return run


class Windows:
    """The windows of some pieces, looked up by hash and verified by their bytes."""

    def __init__(self, items: list[str | None], found: list[bytes], window: int):
        self.items = items
        self.data = np.frombuffer(b"".join(found), np.uint8)
        first, end, of, sizes = [], [], [], []
        base = 0
        for i, piece in enumerate(found):
            starts, ends = words_of(np.frombuffer(piece, np.uint8))
            size = min(window, len(starts))
            n = len(starts) - size + 1
            first.append(starts[:n] + base)
            end.append(ends[size - 1 :] + base)
            of.append(np.full(n, i))
            sizes.append(np.full(n, size))
            base += len(piece)
        first, end, of, sizes = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (first, end, of, sizes))
        # Equal windows of all pieces are one class, told apart by 128 bits and the size.
        hashes, others = self._hashes(self.data, first, end), self._hashes(OTHER[self.data], first, end)
        order = np.lexsort((sizes, others, hashes))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (others[order][1:] != others[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])
        here = order[new]
        self.hashes, self.first, self.end, self.size = hashes[here], first[here], end[here], sizes[here]
        self.items_at = np.r_[np.flatnonzero(new), len(order)]
        self.item_of = of[order].astype(np.int32)
        self.sizes = np.unique(self.size).tolist()
        # One bit in sixteen or fewer is set: most words of a clean document stop here.
        self.bits = int(min(26, max(12, ceil(np.log2(16 * len(here) + 1)))))
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[self._slot(self.hashes)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def _hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of each window, worked out for runs of windows: they stand in order."""
        out = [np.zeros(0, np.uint64)]
        for s in range(0, len(first), SCAN_WORDS):
            starts, ends = first[s : s + SCAN_WORDS], end[s : s + SCAN_WORDS]
            out.append(sequence_hashes(data[starts[0] : ends[-1]], starts - starts[0], ends - starts[0]))
        return np.concatenate(out)

    def scan(self, text: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words of a document are hit, and the pieces its windows come from."""
        hit = np.zeros(len(first) + 1, np.int64)
        met = [np.zeros(0, np.int64)]
        for w in range(0, len(first) if self.sizes else 0, SCAN_WORDS):
            last = min(len(first), w + SCAN_WORDS + self.sizes[-1] - 1)
            data, starts, ends = joined_words(text, first[w:last], end[w:last])
            for size in self.sizes:
                n = min(SCAN_WORDS, len(starts) - size + 1)
                if n <= 0:
                    continue
                hashes = sequence_hashes(data, starts[:n], ends[size - 1 : size - 1 + n])
                at = np.flatnonzero(self.filter[self._slot(hashes)])
                at, kinds = self._verified(data, starts, ends, at, hashes[at], size)
                np.add.at(hit, w + at, 1)
                np.add.at(hit, w + at + size, -1)
                met.append(np.unique(kinds))
        kinds = np.unique(np.concatenate(met))
        pieces = np.unique(self.item_of[ragged(self.items_at[kinds], self.items_at[kinds + 1] - self.items_at[kinds])])
        return np.cumsum(hit[:-1]) > 0, pieces

    def _verified(self, data, starts, ends, at, hashes, size) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows that start at some words, those that stand in an item byte by byte, with
        the class of each."""
        low = np.searchsorted(self.hashes, hashes, "left")
        n = np.searchsorted(self.hashes, hashes, "right") - low
        at, kinds = np.repeat(at, n), ragged(low, n)
        long = ends[at + size - 1] - starts[at]
        good = (self.size[kinds] == size) & (self.end[kinds] - self.first[kinds] == long)
        at, kinds, long = at[good], kinds[good], long[good]
        if not len(at):
            return at, kinds
        same = data[ragged(starts[at], long)] == self.data[ragged(self.first[kinds], long)]
        good = np.logical_and.reduceat(same, np.cumsum(long) - long)
        return at[good], kinds[good]


def _runs(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    return [{"start": int(a), "stop": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _scan_documents(block, window: int, schema: StructType) -> Callable:
    """``text`` and what earlier blocks have found in it, with what this block finds added."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in slices(batches, "text"):
            known = known or Windows(*block.value, window)
            data, at = as_bytes(batch.column("text"))
            runs, items = batch.column("_runs").to_pylist(), batch.column("_items").to_pylist()
            counts = []
            for i in range(batch.num_rows):
                text = data[at[i] : at[i + 1]]
                first, end = words_of(text)
                counts.append(len(first))
                hit, pieces = known.scan(text, first, end)
                if hit.any():
                    for r in runs[i]:
                        hit[r["start"] : r["stop"]] = True
                    runs[i] = _runs(hit)
                    items[i] = sorted({*items[i], *(x for p in pieces.tolist() if (x := known.items[p]) is not None)})
            made = {"_runs": pa.array(runs, pa.list_(_RUN)), "_items": pa.array(items, pa.list_(pa.string())), "_words": pa.array(counts, pa.int64())}
            yield pa.record_batch([made[f] if f in made else batch.column(i) for i, f in enumerate(schema.names)], schema.names)

    return run


def item_pieces(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item, piece, size)``: the distinct items in normal form, long ones cut into pieces."""
    rows = pick(benchmark, item="item_id", text="text").withColumn("item", F.col("item").cast("string"))
    return rows.filter("text is not null").mapInArrow(_item_pieces(window), PIECES).distinct()


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    scratch: Scratch,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents' rows (they need a ``text``) with ``_words`` (how many), ``_runs`` (maximal runs of hit words, by the
    numbers of their first word and of the one behind) and ``_items`` (ids of the items with an
    occurring window, as sorted strings).

    A null or empty text has no words. Items with a null text or without words have no window;
    those without an id hit words but are not in ``_items``. Repeated rows, of either table, change
    nothing: each document row is judged by itself. Columns that begin with ``_words``, ``_runs`` or
    ``_items`` are replaced; all others are handed on.
    """
    spark = documents.sparkSession
    pieces = scratch.keep(item_pieces(benchmark, window), "item_pieces")
    total = pieces.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, ceil(total / block_bytes))
    dealt = F.pmod(F.xxhash64("item", "piece"), F.lit(blocks))
    found = documents.drop("_words", "_runs", "_items").withColumns(
        {"_words": F.lit(0).cast("long"), "_runs": F.array().cast(RUNS), "_items": F.array().cast(ArrayType(StringType()))}
    )
    for k in range(blocks):
        rows = pieces.filter(dealt == k).select("item", "piece").toArrow()
        block = spark.sparkContext.broadcast((rows["item"].to_pylist(), rows["piece"].to_pylist()))
        found = found.mapInArrow(_scan_documents(block, window, found.schema), found.schema)
        if k + 1 < blocks:
            found = scratch.keep(found, "scanned")
            block.unpersist()
    return found


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without their runs of hit words."""
    for batch in slices(batches, "text"):
        texts, runs = batch.column("text").to_pylist(), batch.column("_runs").to_pylist()
        for i, found in enumerate(runs):
            if found:
                data = texts[i].encode()
                first, end = words_of(np.frombuffer(data, np.uint8))
                kept, at = [], 0
                for r in found:
                    kept.append(data[at : first[r["start"]]])
                    at = end[r["stop"] - 1]
                texts[i] = b"".join([*kept, data[at:]]).decode()
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, batch.schema.field("text").type))


def without_leaks(documents: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW, whole: bool = False) -> DataFrame:
    """The documents without the words that are hit, or with ``whole`` without the documents that
    have any. From a run of hit words, all from its first word to its last goes, and nothing else;
    ``n_chars`` follows where there is such a column."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != "text"]
    rows = documents.select("text", F.struct(F.lit(0).alias("_"), *others).alias("row"))
    found = find_leaks(rows, benchmark, scratch, window)
    if whole:
        found = found.filter(F.size("_runs") == 0)
    else:
        found = found.mapInArrow(_cut, found.schema)
        if "n_chars" in documents.columns:
            counted = F.when(F.size("_runs") > 0, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))
            found = found.withColumn("row", F.col("row").withField("n_chars", counted))
    return found.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])


def n_hit(runs: Column) -> Column:
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])


def contamination(documents: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, a row per document row."""
    found = find_leaks(pick(documents, doc_id="doc_id", text="text"), benchmark, scratch)
    return found.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        n_hit(F.col("_runs")).alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("_runs") > 0).alias("contaminated"),
    )
