"""Exact set similarity join on word shingles by partitions of the universe
(after Deng et al., An efficient partition based method for exact set similarity joins, 2016).

Sets of one size band share a partition of the hash space into segments. Two sets of sizes ``s`` and
``t`` with a Jaccard similarity of 3/4 differ in at most ``H = (s + t) / 7`` shingles. So if one of
them has more than ``H`` segments with content, at least one of these is equal in both. A segment's
content is indexed as one signature. A set with too few segments also indexes its segments with any
one shingle left out, each of which takes two differences to miss. Which signatures a set really
uses is decided by cost: those that no other set has cost nothing and come first, then the rarest,
up to ``H + 1``; a set with more than ``H`` signatures of its own has no partner at all. What is
left proposes pairs, and these are verified on their whole sets.

Signatures are shuffled as packed bytes, a run of documents at a time; rows are made only of the
few that are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import as_bytes, mix, pieces, ragged, sequence_hashes, slices
from marginalia.llm.tables import pick, shuffle_width
from marginalia.operators.components import connected_components
from marginalia.scratch import Scratch

WORDS = 5
PERCENT = 75
RUN_BYTES = 12 << 20
SIG_BYTES = 6
DENSE = 128
MOST_BITS = 2048

BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

SIGNED = "part int, run long, held binary, sigs binary, docs binary"
SEEN = "run long, held binary, singles binary, live binary, docs binary"
KEPT = "sig long, band int, n long, high long, low long"


def shingle_sets(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct hashes of every text's shingles of ``words`` words.

    A shorter text has its whole sequence as one shingle; one without words has none.
    """
    data = LOWER[data]
    first, end, owner = pieces(data, at, BLANKS[data]) if len(data) else (np.zeros(0, np.int64),) * 3
    token = sequence_hashes(data, first, end) if len(first) else np.zeros(0, np.uint64)
    count = np.bincount(owner, minlength=len(at) - 1)
    start = np.cumsum(count) - count
    shingle = np.zeros(max(len(token) - words + 1, 0), np.uint64)
    for j in range(words):
        shingle = mix(shingle ^ token[j : j + len(shingle)], j)
    found = []
    for s, n in zip(start.tolist(), count.tolist(), strict=True):
        if n >= words:
            found.append(np.unique(shingle[s : s + n - words + 1]))
        elif n:
            whole = np.zeros(1, np.uint64)
            for value in token[s : s + n]:
                whole = mix(whole ^ value, words + n)
            found.append(whole)
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return tuple(int(mix(shingles, seed).sum(dtype=np.uint64).astype(np.int64)) for seed in (21, 22))


def most_differences(size: int, other: int) -> int:
    """The most shingles in which sets of these sizes may differ and still be similar."""
    return (size + other) // 7


def bands(size: int) -> list[tuple[int, int]]:
    """``(band, most differences)`` for each band in which a set of this size can meet a partner.

    Band b holds the sizes above 2^(b-1) up to 2^b. A pair meets in the band of its smaller set.
    """
    own = (size - 1).bit_length()
    found = [(own, most_differences(size, size * 100 // PERCENT))]
    if own and -(-size * PERCENT // 100) <= 1 << (own - 1):
        found.append((own - 1, most_differences(size, 1 << (own - 1))))
    return found


def segments(band: int) -> int:
    largest = 1 << band
    return 16 * largest if largest <= 16 else largest if largest <= DENSE else largest // 2


def signatures(shingles: np.ndarray, band: int, differences: int) -> tuple[np.ndarray, bool]:
    """A set's signatures in a band, and whether it may use only some of them."""
    of = ((shingles >> np.uint64(32)) * np.uint64(segments(band)) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    content = np.add.reduceat(mix(shingles, 31), starts)
    place = of[starts].astype(np.uint64) + np.uint64((band + 1) << 40)
    exact = mix(content ^ mix(place, 32), 33)
    if len(starts) > differences:
        return exact, True
    sizes = np.diff(np.r_[starts, len(shingles)])
    several = np.repeat(sizes > 1, sizes)
    left_out = np.repeat(content, sizes)[several] - mix(shingles, 31)[several]
    nearly = mix(left_out ^ mix(np.repeat(place, sizes)[several], 32), 33)
    both = [exact, nearly]
    if np.minimum(sizes, 2).sum() <= differences:
        both.append(mix(np.array([(band + 1) << 40], np.uint64), 34))  # all such sets of a band meet
    return np.unique(np.concatenate(both)), False


def sketch_bits(band: int) -> int:
    return min(max(1 << (band + 2), 64), MOST_BITS)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each bit. Where two sketches differ, a shingle
    is in one set only, so they differ in no more bits than the sets in shingles."""
    bits = sketch_bits(bands(len(shingles))[0][0])
    odd = np.bincount((mix(shingles, 41) % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(array.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _sets(words: int):
    """``(doc_id, n, high, low, sketch)`` of every document: size, key and sketch of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(*as_bytes(part.column("text")), words)
            keys = np.array([set_key(s) for s in sets], np.int64).reshape(-1, 2)
            columns = [
                part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                pa.array([sketch(s) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "high", "low", "sketch"])

    return run


def _sign(words: int, parts: int, most: int) -> Callable:
    """Runs of documents to one row of packed signatures per part of the hash space.

    Of equal sets in a run only the first goes on. ``docs`` tells the run's sets and goes along
    with one of its parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, seen, known, sigs, held, docs = 0, 0, 0, set(), [], [], []

        def close() -> Iterator[pa.RecordBatch]:
            name = (task << 24) + number
            flat = np.concatenate(sigs) if sigs else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(held)), held)
            part = (flat % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part.astype(np.uint16 if parts < 65536 else np.int64), kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            rows = []
            for p in range(parts):
                some = order[ends[p] : ends[p + 1]]
                info = _pack(np.array(docs, "<i8")) if p == name % parts else None
                if len(some) or info:
                    high = flat[some].view(np.uint8).reshape(-1, 8)[:, 8 - SIG_BYTES :]
                    count = np.bincount(owner[some], minlength=len(held)).astype("<u4")
                    rows.append((p, name, _pack(count), np.ascontiguousarray(high).tobytes(), info))
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], ["part", "run", "held", "sigs", "docs"])

        for batch in slices(batches, "text"):
            task = batch.column("task")[0].as_py()
            data, at = as_bytes(batch.column("text"))
            for shingles in shingle_sets(data, at, words):
                if not len(shingles) or (key := set_key(shingles)) in known:
                    continue
                known.add(key)
                for band, differences in bands(len(shingles)):
                    found, free = signatures(shingles, band, differences)
                    sigs.append(found)
                    held.append(len(found))
                    docs.append((len(shingles), band, differences if free else -1, *key))
            seen += len(data)
            if seen > most:
                yield from close()
                number, seen, known, sigs, held, docs = number + 1, 0, set(), [], [], []
        if held:
            yield from close()

    return run


def _find_shared(rows: pd.DataFrame) -> pd.DataFrame:
    """One part of the hash space: per run and set, how many signatures are its own, and the
    others with the number of sets that have them."""
    part = int(rows["part"].iloc[0])
    raw = b"".join(rows["sigs"])
    sig = np.zeros((len(raw) // SIG_BYTES, 8), np.uint8)
    sig[:, :SIG_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, SIG_BYTES)
    sig = sig.view("<u8").ravel()
    order = np.argsort(sig)
    fresh = np.r_[True, sig[order][1:] != sig[order][:-1]][: len(sig)]
    size = np.diff(np.r_[np.flatnonzero(fresh), len(sig)])
    times = np.zeros(len(sig), np.int64)
    times[order] = np.repeat(size, size)
    at, out = 0, []
    for run, held, sigs, docs in zip(rows["run"], rows["held"], rows["sigs"], rows["docs"], strict=True):
        count = _unpack(held, "<u4").astype(np.int64)
        here = slice(at, at + len(sigs) // SIG_BYTES)
        at = here.stop
        owner = np.repeat(np.arange(len(count)), count)
        live = times[here] > 1
        singles = np.bincount(owner[~live], minlength=len(count)).astype("<u4")
        kept = np.bincount(owner[live], minlength=len(count)).astype("<u4")
        named = (sig[here][live] << np.uint64(15)) ^ np.uint64(part)
        pairs = np.stack([named.view(np.int64), times[here][live]], axis=1)
        out.append((run, _pack(kept), _pack(singles), _pack(pairs.astype("<i8")), docs))
    return pd.DataFrame(out, columns=["run", "held", "singles", "live", "docs"])


def _choose(rows: pd.DataFrame) -> pd.DataFrame:
    """One run: the shared signatures that each of its sets uses."""
    docs = _unpack(next(d for d in rows["docs"] if d is not None), "<i8").reshape(-1, 5)
    singles = sum(_unpack(s, "<u4").astype(np.int64) for s in rows["singles"])
    owner, pairs = [], []
    for held, live in zip(rows["held"], rows["live"], strict=True):
        count = _unpack(held, "<u4").astype(np.int64)
        owner.append(np.repeat(np.arange(len(count)), count))
        pairs.append(_unpack(live, "<i8").reshape(-1, 2))
    owner, pairs = np.concatenate(owner), np.concatenate(pairs)
    order = np.lexsort((pairs[:, 0], pairs[:, 1], owner))
    owner, pairs = owner[order], pairs[order]
    count = np.bincount(owner, minlength=len(docs))
    wanted = np.where(docs[:, 2] < 0, count, np.clip(docs[:, 2] + 1 - singles, 0, count))
    chosen = ragged(np.cumsum(count) - count, wanted)
    of = docs[np.repeat(np.arange(len(docs)), wanted)]
    return pd.DataFrame({"sig": pairs[chosen, 0], "band": of[:, 1].astype(np.int32), "n": of[:, 0], "high": of[:, 3], "low": of[:, 4]})


def _compare(words: int):
    """Pairs with both texts, packed, to pairs that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            fits = []
            for a, one, two in zip(batch.column("a").to_pylist(), batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                if a != last:
                    last, left = a, _set_of(one, words)
                right = _set_of(two, words)
                common = len(np.intersect1d(left, right, assume_unique=True))
                fits.append(100 * common >= PERCENT * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return run


def _set_of(packed: bytes, words: int) -> np.ndarray:
    data = _unpack(packed, np.uint8)
    return shingle_sets(data, np.array([0, len(data)]), words)[0]


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        texts = [_pack(np.frombuffer((t or "").encode(), np.uint8)) for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])


def _texts(ids: DataFrame, documents: DataFrame, scratch: Scratch) -> DataFrame:
    """The packed texts of some ids. The ids grow with the documents, so they are not broadcast."""
    texts = documents.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(_packed_texts, "doc_id long, text binary")
    return scratch.keep(texts.dropDuplicates(["doc_id"]), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are similar."""
    both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b").join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a"
    )
    return scratch.keep(both.select("a", "b", "text_a", "text_b").mapInArrow(_compare(words), "a long, b long"), "verified")


def similar_documents(documents: DataFrame, scratch: Scratch, words: int = WORDS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every id in ``documents(doc_id, text)``.

    Documents link if the Jaccard similarity of their sets of shingles is at least 3/4; a component's
    id is the smallest in it. Documents without words, null texts among them, link with nothing.
    Rows with a null id take no part. Of several rows with one id one counts, so equal rows as one.
    Sets are compared by 64-bit hashes of their shingles, equal sets by 128 bits of theirs.

    Equal sets are looked at once. Sets that share a signature are first compared with the smallest
    of them; only where that leaves several components are the pairs between these looked at, first by
    their sketches. So large groups of near copies cost about one comparison per document, and no link between
    different components is lost.
    """
    known = documents.filter(F.col("doc_id").isNotNull())
    sized = known.mapInArrow(_sets(words), "doc_id long, n long, high long, low long, sketch array<bigint>")
    sized = sized.groupBy("doc_id").agg(F.min(F.struct("n", "high", "low", "sketch")).alias("s")).select("doc_id", "s.*")
    sized = scratch.keep(sized, "sets")
    equal = ["n", "high", "low"]
    classes = sized.filter("n > 0").groupBy(*equal).agg(F.min("doc_id").alias("id"))
    parts = shuffle_width(documents)
    signed = known.select("text", F.spark_partition_id().cast("long").alias("task")).mapInArrow(_sign(words, parts, run_bytes), SIGNED)
    shared = signed.groupBy("part").applyInPandas(_find_shared, SEEN)
    kept = shared.groupBy("run").applyInPandas(_choose, KEPT)
    used = kept.join(classes, equal).select("sig", "band", "id", "n").distinct()
    used = scratch.keep(used, "used")

    lead = used.groupBy("sig", "band").agg(F.min(F.struct("id", "n")).alias("lead"), F.count("*").alias("k")).filter("k > 1")
    near = 100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m")
    stars = used.join(lead.select("sig", "band", F.col("lead.id").alias("a"), F.col("lead.n").alias("m")), ["sig", "band"])
    stars = stars.filter((F.col("id") != F.col("a")) & near).select("a", F.col("id").alias("b")).distinct()
    stars = scratch.keep(stars, "stars")
    met = used.join(lead.select("sig", "band"), ["sig", "band"]).select(F.col("id").alias("doc_id")).distinct()
    texts = _texts(met, known, scratch)
    links = _verified(stars, texts, words, scratch)
    found = scratch.keep(_components(links, scratch), "first_components")

    grouped = used.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = grouped.groupBy("sig", "band").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least < most")
    sketches = sized.select(F.col("doc_id").alias("id"), "sketch")
    open_ones = grouped.join(split.select("sig", "band"), ["sig", "band"]).join(sketches, "id")
    open_ones = scratch.keep(open_ones.withColumn("sketch", _folded("sketch", "band")), "open")
    other = open_ones.select("sig", "band", F.col("id").alias("b"), F.col("n").alias("m"), F.col("component").alias("far"), F.col("sketch").alias("other"))
    unlike = F.aggregate(F.zip_with("sketch", "other", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    rest = (
        open_ones.join(other, ["sig", "band"])
        .filter((F.col("component") < F.col("far")) & near & (7 * unlike <= F.col("n") + F.col("m")))
        .select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    rest = scratch.keep(rest, "rest")
    if not rest.isEmpty():
        more = _verified(rest, texts, words, scratch)
        if not more.isEmpty():
            found = scratch.keep(_components(links.unionByName(more), scratch), "components")
    of_class = classes.join(found, "id", "left").select(*equal, F.coalesce("component", "id").alias("component"))
    return sized.join(of_class, equal, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def _folded(name: str, band: str) -> Column:
    """The sketch at the width of the band: a set of the next band has one of twice that width."""
    wanted = F.least(F.greatest(F.pow(F.lit(2), F.col(band) + 2), F.lit(64)), F.lit(MOST_BITS)) / 64
    half = (F.size(name) / 2).cast("int")
    halves = F.zip_with(F.slice(name, F.lit(1), half), F.slice(name, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(name) > wanted, halves).otherwise(F.col(name))


def _components(links: DataFrame, scratch: Scratch) -> DataFrame:
    return connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), scratch)


def near_documents(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """``similar_documents`` whatever other columns there are."""
    return similar_documents(pick(documents, doc_id="doc_id", text="text"), scratch)
