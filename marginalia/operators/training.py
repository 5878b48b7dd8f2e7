"""Word vectors by skip-grams and hierarchical softmax, with the model parted among tasks.

As Spark's own trainer does, parts of the corpus are trained side by side in each round, and a number that
several parts have changed becomes their mean. But no one holds the model: a part ("slice") holds the vectors
of its own words and of the inner nodes above them, and sends them as packed rows to the "buckets" of keys
where they are averaged and from where each slice gets its own back. So memory is bounded by ``MODEL_BYTES``
and ``BUCKET_BYTES``, whatever the vocabulary.

Disk is bounded too: the slices of a round take turns in "waves" of about as many as can run at once. A wave's
vectors are added to the sums of those before, and what was shuffled for it goes before the next one. So the
shuffled vectors are those of a wave, not of all slices; beside them stand the model and its sums, once each.

The tree is a canonical Huffman tree, whose shape follows from the number of words of each count. A key is a
code after a leading 1: a word's is its leaf's, and the keys of the inner nodes above are its prefixes.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from math import ceil, exp

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.scratch import Scratch, held_settings, shuffles_removed

# Words trained as one sentence at most, and the first and least step, as in Spark's trainer.
SENTENCE = 1_000
STEP, LEAST_STEP = 0.025, 0.025 * 1e-4
MAX_EXPONENT = 6

# Tokens of a piece, of which slices are made; tokens and bytes of vectors of a slice; bytes of a bucket.
PIECE_TOKENS = 25_000
SLICE_TOKENS = 16_000_000
MODEL_BYTES = 256 << 20
BUCKET_BYTES = 16 << 20
SENT_BYTES = 4 << 20  # sent on at a time
# Bytes of vectors that a wave of slices is given, where that is more than one slice per core; tokens that are laid out at once.
WAVE_BYTES = 128 << 20
ENCODED_TOKENS = 64_000_000
# Rounds of a model of less than a bucket that run without a write in between.
ROUNDS_PER_WRITE = 4

# Between rounds vectors travel as halves, which is half the disk; what comes of the last round as full floats.
BETWEEN = "<f2"

# Rows of many bytes go to Python a few at a time.
BATCH_BYTES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(SENT_BYTES)}

# Tokens trained at a time.
BATCH = 128

# For rows of packed numbers, which may be large: small row groups, whose size is looked at often.
LARGE_ROWS = {
    "compression": "uncompressed",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1",
    "parquet.enable.dictionary": "false",
}

TRAINED = "slice int, bucket int, keys binary, matrix binary"
HELD = "bucket int, keys binary, matrix binary, counts binary"
VECTORS = "key bigint, vector array<float>"


def _packed(numbers: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones, and so on, as most high bytes are null."""
    raw = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Rising keys, by their distances."""
    return _packed(np.diff(keys, prepend=np.int64(0)))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<i8"))


def _packed_words(words: pa.Array) -> tuple[bytes, bytes]:
    """Their letters in a row, and how many bytes each has."""
    words = words.cast(pa.string())
    _, ends, letters = words.buffers()
    ends = np.frombuffer(ends, "<i4")[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, "<i4")
    letters = np.frombuffer(letters or b"", np.uint8)[ends[0] : ends[-1]]
    return _packed(letters), _packed(np.diff(ends))


def _unpacked_words(letters: bytes, sizes: bytes) -> pa.Array:
    ends = np.cumsum(np.append(0, _unpacked(sizes, "<i4"))).astype("<i4")
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(_unpacked(letters, "u1")))


PIECES = "task int, number bigint, letters binary, letter_counts binary, counts binary, at binary, sizes binary"


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sentences with about ``PIECE_TOKENS`` tokens, a row each: different words, how often each comes,
    the words' places in order, and the sentences' lengths."""
    task, number = TaskContext.get().partitionId(), 0

    def row(held: list[pa.Array]) -> pa.RecordBatch:
        sentences = pa.concat_arrays(held)
        sizes = sentences.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("<i4")
        found = sentences.flatten().dictionary_encode()
        at = found.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype("<i4")
        counts = np.bincount(at[at >= 0], minlength=len(found.dictionary)).astype("<i8")
        letters, letter_counts = _packed_words(found.dictionary)
        columns = [[task], [number], [letters], [letter_counts], [_packed(counts)], [_packed(at)], [_packed(sizes)]]
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
        names = ["task", "number", "letters", "letter_counts", "counts", "at", "sizes"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    held, total = [], 0
    for batch in batches:
        sentences = batch.column("tokens")
        ends = np.cumsum(sentences.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < len(sentences):
            before = int(ends[first - 1]) if first else 0
            last = min(len(sentences), int(np.searchsorted(ends, before + PIECE_TOKENS - total)) + 1)
            held.append(sentences.slice(first, last - first))
            total += int(ends[last - 1]) - before
            first = last
            if total >= PIECE_TOKENS:
                yield row(held)
                held, total, number = [], 0, number + 1
    if total:
        yield row(held)


def _words_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different word of a piece, with the piece's slice and how often the word comes."""
    for batch in batches:
        for row in batch.to_pylist():
            words = _unpacked_words(row["letters"], row["letter_counts"])
            slices = pa.array(np.full(len(words), row["slice"], np.int32))
            yield pa.record_batch([slices, words, pa.array(_unpacked(row["counts"], "<i8"))], ["slice", "word", "n"])


def code_lengths(words_by_count: dict[int, int]) -> dict[int, int]:
    """How many words have a Huffman code of each length, from how many words have each count.

    Nodes of equal make are merged in bundles, so the work follows the number of different counts.
    """
    heap = [(count, bundle, words) for bundle, (count, words) in enumerate(sorted(words_by_count.items()))]
    leaves = len(heap)
    above: list[list[tuple[int, int]]] = [[] for _ in heap]  # bundles made of this one, and how many each node takes

    def merge(weight: int, nodes: int, taken: dict[int, int]) -> None:
        for bundle, each in taken.items():
            above[bundle].append((len(above), each))
        heapq.heappush(heap, (weight, len(above), nodes))
        above.append([])

    while heap:
        weight, bundle, nodes = heapq.heappop(heap)
        if nodes > 1:
            merge(2 * weight, nodes // 2, {bundle: 2})
            if nodes % 2:
                heapq.heappush(heap, (weight, bundle, 1))
        elif heap:
            more, other, others = heapq.heappop(heap)
            if others > 1:
                heapq.heappush(heap, (more, other, others - 1))
            merge(weight + more, 1, {bundle: 1, other: 1})
    depths: list[dict[int, int]] = [defaultdict(int) for _ in above]
    depths[-1][0] = 1
    for bundle in range(len(above) - 2, -1, -1):
        for made, each in above[bundle]:
            for depth, nodes in depths[made].items():
                depths[bundle][depth + 1] += each * nodes
    lengths: dict[int, int] = defaultdict(int)
    for own in depths[:leaves]:
        for depth, words in own.items():
            lengths[depth] += words
    return dict(sorted(lengths.items()))


def _keys(counts: DataFrame, words_by_count: dict[int, int], scratch: Scratch) -> DataFrame:
    """``(word, key)``: more frequent words get the shorter codes, in order."""
    # Sorted by ranges; a word's place is that in its part, after the words of the parts before.
    ordered = counts.orderBy(F.desc("n"), "word").withColumn("at", F.monotonically_increasing_id())
    ordered = scratch.keep(ordered, "ordered").select("word", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("place"))
    before, starts = 0, {}
    for row in ordered.groupBy("part").count().orderBy("part").collect():
        starts[row["part"]] = before
        before += row["count"]
    starts = F.lit([starts.get(part, 0) for part in range(max(starts) + 1)])
    rank = F.col("place") + F.get(starts, F.col("part").cast("int"))
    key, first, code, length = None, 0, 0, 0
    for longer, words in code_lengths(words_by_count).items():
        code, length = code << (longer - length), longer
        coded = rank + F.lit((1 << length) + code - first)
        first, code = first + words, code + words
        key = F.when(rank < first, coded) if key is None else key.when(rank < first, coded)
    return ordered.select("word", key.alias("key"))


def _slice_count(words_by_count: dict[int, int], tokens: int, dimension: int, least: int) -> int:
    """So many slices that each has the tokens and, as a rule, the vectors that a task may hold."""

    def vectors(slices: int) -> float:
        """Of words and inner nodes that come in one slice, where those above a word get twice as few each level."""
        weights = ((words / 2**level, count * 2**level) for count, words in words_by_count.items() for level in range(40))
        return sum(number * (1 - exp(-weight / slices)) for number, weight in weights)

    slices = max(1, least, ceil(tokens / SLICE_TOKENS))
    while slices < tokens and vectors(slices) * dimension * 4 > MODEL_BYTES:
        slices = ceil(slices * 1.25)
    return slices


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _encode(pieces: pa.Table, given: pa.Table) -> pa.Table:
    """A slice's row: its words' keys, its tokens as places among them, its sentences' lengths, and how many
    vectors it has. Unknown words go, and what is left of a long sentence is cut."""
    if not pieces.num_rows or not given.num_rows:
        return ENCODED.empty_table()
    keys = np.sort(np.array(_column(given, "key"), np.int64))
    place = np.append(np.searchsorted(keys, np.array(_column(given, "key"), np.int64)), -1).astype("<i4")
    tokens, lengths = [], []
    pieces = pieces.take(np.lexsort((_column(pieces, "number"), _column(pieces, "task"))))
    words = [_unpacked_words(*w) for w in zip(_column(pieces, "letters"), _column(pieces, "letter_counts"), strict=True)]
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    found = pc.index_in(pa.chunked_array(words, pa.string()), value_set=given.column("word").combine_chunks().cast(pa.string()))
    place = place[found.fill_null(-1).to_numpy()]
    for at, sizes, own in zip(_column(pieces, "at"), _column(pieces, "sizes"), np.split(place, ends[:-1]), strict=True):
        known = np.append(own, -1)[_unpacked(at, "<i4")]
        sentence = np.repeat(np.arange(len(_unpacked(sizes, "<i4"))), _unpacked(sizes, "<i4"))[known >= 0]
        tokens.append(known[known >= 0])
        lengths.append(_cut(np.bincount(sentence)))
    tokens, lengths = np.concatenate(tokens).astype("<i4"), np.concatenate(lengths).astype("<i4")
    columns = [[pieces.column("slice")[0].as_py()], [_packed_keys(keys)], [_packed(tokens)], [_packed(lengths)], [len(_with_nodes(keys))]]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, ENCODED, strict=True)], schema=ENCODED)


def _cut(sizes: np.ndarray) -> np.ndarray:
    """Lengths of sentences, of which long ones count as several; empty ones go."""
    sizes = sizes[sizes > 0]
    parts = -(-sizes // SENTENCE)
    cut = np.full(parts.sum(), SENTENCE)
    cut[np.cumsum(parts) - 1] = sizes - (parts - 1) * SENTENCE
    return cut


ENCODED_ROWS = "slice int, words binary, tokens binary, lengths binary, vectors bigint"
ENCODED = pa.schema([("slice", pa.int32()), ("words", pa.binary()), ("tokens", pa.binary()), ("lengths", pa.binary()), ("vectors", pa.int64())])


def _with_nodes(keys: np.ndarray) -> np.ndarray:
    """Sorted keys with those of all nodes above them."""
    every, level = [keys], keys
    while len(level := np.unique(level[level > 1] >> 1)):
        every.append(level)
    return np.unique(np.concatenate(every))


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Unsigned numbers, well mixed (splitmix64)."""
    numbers = (numbers ^ (numbers >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    numbers = (numbers ^ (numbers >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return numbers ^ (numbers >> np.uint64(31))


def _first_vectors(keys: np.ndarray, words: np.ndarray, dimension: int, seed: int) -> np.ndarray:
    """Small random numbers for words, the same in every slice; null for inner nodes."""
    matrix = np.zeros((len(keys), dimension), np.float32)
    places = np.arange(1, dimension + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = np.searchsorted(keys, words)
    for start in range(0, len(rows), 4096):
        own = rows[start : start + 4096]
        base = _mixed(keys[own].astype(np.uint64) + np.uint64(seed % (1 << 63)) * np.uint64(0xD1342543DE82EF95))
        mixed = _mixed(base[:, None] + places[None, :]) >> np.uint64(40)
        matrix[own] = (mixed.astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(dimension)
    return matrix


def _skip_grams(sizes: np.ndarray, window: int, dice: np.random.Generator, batch: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(start, end, centre, context)``: a batch of tokens and the pairs in windows of random width around them,
    centres by their place in the batch, contexts by that among the tokens from ``start - window`` on."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    offsets = np.concatenate([np.arange(-window, 0), np.arange(1, window + 1)])
    for start in range(0, total, batch):
        end = min(start + batch, total)
        at = np.arange(start, end)
        sentence = np.searchsorted(ends, at, "right")
        width = window - dice.integers(0, window, len(at))
        low = np.maximum(-width, ends[sentence] - sizes[sentence] - at)
        high = np.minimum(width, ends[sentence] - 1 - at)
        centre, context = np.nonzero((offsets >= low[:, None]) & (offsets <= high[:, None]))
        yield start, end, centre, centre + offsets[context] + window


def _different(numbers: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers, and which of them each is; ``place`` has room for one entry per possible number."""
    at = np.arange(len(numbers), dtype=np.int32)
    place[numbers] = at
    same = place[numbers]  # one and the same of those that are equal
    kept = same == at
    return numbers[kept], (np.cumsum(kept, dtype=np.int32) - 1)[same]


def _train(matrix: np.ndarray, keys: np.ndarray, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, window: int, done: float, rounds: int, dice: np.random.Generator) -> None:
    """One round over a slice's sentences; changes the matrix.

    The tokens of a batch are trained at once: the vectors of all words in and around it times those of all the
    inner nodes above them, where only products of pairs that come are looked at, as often as they come. A row
    goes no further than where its own loss, by the greatest curvature it may have, could be least.
    """
    row_of = np.searchsorted(keys, words)
    length = np.array([k.bit_length() - 1 for k in words.tolist()], np.int32)
    # By word and level: the row of the node above, and 1 where the path goes left there, -1 for right, 0 beyond it.
    levels = int(length.max(initial=0))
    side, path = np.empty((len(words), levels), np.int8), np.empty((len(words), levels), np.int32)
    for level in range(levels):  # not all at once, as numbers of 8 bytes
        shift = np.maximum(length - level - 1, 0)
        side[:, level] = (1 - 2 * ((words >> shift) & 1)) * (level < length)
        path[:, level] = np.searchsorted(keys, words >> np.minimum(shift + 1, 62))
    place, place_of_word, pulls = np.zeros(len(keys), np.int32), np.zeros(len(words), np.int32), np.zeros(0, np.float32)
    batch = min(BATCH, max(8, len(words) // 8))
    for start, end, centre, context in _skip_grams(sizes, window, dice, batch):
        if not len(centre):
            continue
        step = np.float32(max(STEP * (1 - (done + start / len(tokens)) / rounds), LEAST_STEP))
        inner, inner_of = _different(tokens[max(0, start - window) : end + window], place_of_word)
        context = inner_of[context - max(0, window - start)]
        # The nodes above each token, and the side that its path takes there.
        own_tokens = tokens[start:end]
        many = length[own_tokens]
        first = np.cumsum(many, dtype=np.int32) - many
        sides = side[own_tokens]
        of = np.repeat(np.arange(end - start, dtype=np.int32), many)
        there = sides != 0
        above, sides = path[own_tokens][there], sides[there].astype(np.float32)
        nodes, above = _different(above, place)
        own = row_of[inner]
        x, y = matrix.take(own, axis=0), matrix.take(nodes, axis=0)
        product = x @ y.T
        # The nodes above the centre of each pair, and where their products with its context stand.
        times = many[centre]
        ends = np.cumsum(times, dtype=np.int32)
        which = np.arange(ends[-1], dtype=np.int32) + np.repeat(first[centre] - ends + times, times)
        cell = above[which] + np.repeat(context * np.int32(len(nodes)), times)
        value = product.ravel().take(cell)
        toward = sides[which]
        pull = toward / (1 + np.exp(np.minimum(toward * value, MAX_EXPONENT)))
        pull[np.abs(value) >= MAX_EXPONENT] = 0
        if len(pulls) < product.size:
            pulls = np.zeros(2 * product.size, np.float32)
        np.add.at(pulls, cell, pull)
        pull = pulls[: product.size].reshape(product.shape)
        # Sums of squares of the vectors each row meets.
        square = np.bincount(centre, np.einsum("xd,xd->x", x, x)[context], minlength=end - start)
        square_y = np.bincount(above, square[of], minlength=len(nodes))
        square = np.bincount(of, np.einsum("yd,yd->y", y, y)[above], minlength=end - start)
        square_x = np.bincount(context, square[centre], minlength=len(inner))
        matrix[own] = x + (step / np.maximum(1, square_x * (step / 4))).astype(np.float32)[:, None] * (pull @ y)
        matrix[nodes] = y + (step / np.maximum(1, square_y * (step / 4))).astype(np.float32)[:, None] * (pull.T @ x)
        pulls[cell] = 0


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets, and which of the keys each has, in order."""
    of = (_mixed(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        yield int(of[own[0]]), own


def _round(dimension: int, window: int, number: int, rounds: int, buckets: int, seed: int) -> Callable:
    """From slices' rows and their vectors (none in the first round) the trained vectors by
    bucket; in the last round those of words alone."""

    def trained(row: dict, keys: np.ndarray, matrix: np.ndarray) -> Iterator[tuple]:
        words, tokens, sizes = _unpacked_keys(row["words"]), _unpacked(row["tokens"], "<i4"), _unpacked(row["lengths"], "<i4")
        _train(matrix, keys, words, tokens, sizes, window, number, rounds, np.random.default_rng([seed % (1 << 63), number, row["slice"]]))
        sent = np.searchsorted(keys, words) if number == rounds - 1 else np.arange(len(keys))
        for bucket, own in _dealt(keys[sent], buckets):
            yield row["slice"], bucket, _packed_keys(keys[sent[own]]), matrix[sent[own]].astype(kind).tobytes()

    kind = _kind(number, rounds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, early = {}, defaultdict(list)  # of one slice, as they are dealt
        for batch in batches:
            matrices = batch.column("matrix")
            for i, row in enumerate(batch.drop_columns("matrix").to_pylist()):
                if row["tokens"] is None:
                    early[row["slice"]].append((_unpacked_keys(row["keys"]), matrices[i]))
                else:
                    words = _unpacked_keys(row["words"])
                    keys = _with_nodes(words)
                    matrix = np.empty((len(keys), dimension), np.float32) if number else _first_vectors(keys, words, dimension, seed)
                    slices[row["slice"]] = row, keys, matrix
            for of, (_, keys, matrix) in slices.items():  # vectors wait for their slice's words only
                for own, some in early.pop(of, ()):
                    matrix[np.searchsorted(keys, own)] = _matrix(some, len(own), BETWEEN)
        while slices:
            yield from _sent(trained(*slices.popitem()[1]))

    return run


def _kind(number: int, rounds: int) -> str:
    """What a round's trained vectors travel as."""
    return "<f4" if number == rounds - 1 else BETWEEN


TRAINED_SCHEMA = pa.schema([("slice", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("matrix", pa.binary())])
HELD_SCHEMA = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("matrix", pa.binary()), ("counts", pa.binary())])


def _matrix(scalar: pa.Scalar, rows: int, kind: str) -> np.ndarray:
    return np.frombuffer(scalar.as_buffer(), kind).reshape(rows, -1)


def _columns(rows: Iterable[tuple], schema: pa.Schema) -> list[pa.Array]:
    return [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]


def _sent(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches of a few MB."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= SENT_BYTES:
            yield pa.record_batch(_columns(held, TRAINED_SCHEMA), schema=TRAINED_SCHEMA)
            held, size = [], 0
    if held:
        yield pa.record_batch(_columns(held, TRAINED_SCHEMA), schema=TRAINED_SCHEMA)


def _asked(buckets: int) -> Callable:
    """From slices' rows the keys whose vectors each asks of each bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = _with_nodes(_unpacked_keys(row["words"]))
                rows = [(row["slice"], bucket, _packed_keys(keys[own])) for bucket, own in _dealt(keys, buckets)]
                yield pa.record_batch(_columns(rows, TRAINED_SCHEMA.remove(3)), schema=TRAINED_SCHEMA.remove(3))

    return run


def _answered(model: pa.Table, asked: pa.Table) -> pa.Table:
    """What slices asked of a bucket."""
    if not asked.num_rows:
        return TRAINED_SCHEMA.empty_table()
    keys = _unpacked_keys(model.column("keys")[0].as_py())
    matrix = _matrix(model.column("matrix")[0], len(keys), BETWEEN)
    rows = ((*row.values(), matrix[np.searchsorted(keys, _unpacked_keys(row["keys"]))].tobytes()) for row in asked.select(["slice", "bucket", "keys"]).to_pylist())
    return pa.table(_columns(rows, TRAINED_SCHEMA), schema=TRAINED_SCHEMA)


def _added(dimension: int, kind: str, over: bool) -> Callable:
    """With what a wave has trained, to what the waves before have left of a bucket, if anything."""

    def added(held: pa.Table, trained: pa.Table) -> pa.Table:
        return _sums(dimension, kind, over, held, trained)

    return added


def _first_added(dimension: int, kind: str, over: bool) -> Callable:
    def added(trained: pa.Table) -> pa.Table:
        return _sums(dimension, kind, over, HELD_SCHEMA.empty_table(), trained)

    return added


def _sums(dimension: int, kind: str, over: bool, held: pa.Table, trained: pa.Table) -> pa.Table:
    """A bucket's sums of equal keys' vectors over the slices that have them, and of how many, with those of the
    waves before. After the last wave the means: as the next round takes them, or at last ``(key, vector)``."""
    rows = sorted((number, i) for i, number in enumerate(_column(trained, "slice")))
    own = [_unpacked_keys(trained.column("keys")[i].as_py()) for _, i in rows]
    before = _unpacked_keys(held.column("keys")[0].as_py()) if held.num_rows else np.zeros(0, np.int64)
    keys = np.unique(np.concatenate([before, *own]))
    sums, counts = np.zeros((len(keys), dimension), np.float32), np.zeros(len(keys), "<i4")
    if held.num_rows:
        at = np.searchsorted(keys, before)
        sums[at] = _matrix(held.column("matrix")[0], len(before), "<f4")
        counts[at] = _unpacked(held.column("counts")[0].as_py(), "<i4")
    for (_, i), some in zip(rows, own, strict=True):
        at = np.searchsorted(keys, some)
        sums[at] += _matrix(trained.column("matrix")[i], len(some), kind)
        counts[at] += 1
    bucket = (held if held.num_rows else trained).column("bucket")[0].as_py()
    if not over:
        return pa.table(_columns([(bucket, _packed_keys(keys), sums.tobytes(), _packed(counts))], HELD_SCHEMA), schema=HELD_SCHEMA)
    sums /= counts[:, None]
    if kind == BETWEEN:
        return pa.table(_columns([(bucket, _packed_keys(keys), sums.astype(BETWEEN).tobytes(), None)], HELD_SCHEMA), schema=HELD_SCHEMA)
    offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * dimension)
    return pa.table({"key": keys, "vector": pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))})


def train(corpus: DataFrame, dimension: int, window: int, iterations: int, partitions: int, min_count: int, seed: int, scratch: Scratch) -> DataFrame:
    """``(word, vector)`` of the words that come ``min_count`` times in ``corpus(tokens)``.

    The corpus is read once. ``partitions`` slices at least are trained apart from each other, as far as there
    are that many pieces; more, where a slice's vectors would be too many for a task.
    """
    with shuffles_removed(corpus.sparkSession):
        keys, encoded, words = _laid_out(corpus, dimension, partitions, min_count, scratch)
        with held_settings(corpus.sparkSession, BATCH_BYTES):
            vectors = _trained(encoded, words, dimension, window, iterations, seed, scratch)
        scratch.drop(encoded)
    return keys.join(vectors, "key").select("word", F.col("vector").cast("array<double>").alias("vector"))


def _laid_out(corpus: DataFrame, dimension: int, partitions: int, min_count: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """``(word, key)`` of the vocabulary, a row for each slice of the corpus (``_encode``), and how many words there are."""
    pieces = scratch.keep(corpus.select("tokens").mapInArrow(_pieces, PIECES), "pieces", **LARGE_ROWS)
    words = ("slice", "letters", "letter_counts", "counts")
    counted = pieces.withColumn("slice", F.lit(0)).select(*words).mapInArrow(_words_of, "slice int, word string, n bigint")
    counts = counted.groupBy("word").agg(F.sum("n").alias("n"))
    counts = scratch.keep(counts.filter((F.col("n") >= min_count) & F.col("word").isNotNull()), "counts", compression="zstd")
    words_by_count = {row["n"]: row["words"] for row in counts.groupBy("n").agg(F.count("*").alias("words")).collect()}
    if not words_by_count:
        raise ValueError("The vocabulary size should be > 0. You may need to check the setting of minCount, which could be large enough to remove all your words in sentences.")
    keys = scratch.keep(_keys(counts, words_by_count, scratch), "keys", compression="zstd")
    scratch.drop(counts)
    tokens = sum(n * words for n, words in words_by_count.items())
    slices = _slice_count(words_by_count, tokens, dimension, partitions)
    # The pieces of a task go to slices in turn.
    pieces_at = pieces.withColumn("slice", F.pmod(F.xxhash64("task") + F.col("number"), F.lit(slices)).cast("int"))
    given = pieces_at.select(*words).mapInArrow(_words_of, "slice int, word string, n bigint")
    given = given.select(F.col("slice").alias("of"), "word").distinct().join(keys, "word").select("of", "word", "key")
    given = scratch.keep(given, "given", compression="zstd")

    def encoded(first: int, end: int) -> DataFrame:
        def by(df: DataFrame, key: str):
            own = df.filter(F.col(key).between(first, end - 1))
            return own.repartition(end - first, key).groupBy(key)  # as many tasks as slices

        return by(pieces_at.drop("counts"), "slice").cogroup(by(given, "of")).applyInArrow(_encode, ENCODED_ROWS)

    some = max(1, slices // ceil(tokens / ENCODED_TOKENS))
    found = scratch.keep_all((encoded(first, min(first + some, slices)) for first in range(0, slices, some)), "encoded", **LARGE_ROWS)
    scratch.drop(pieces)
    scratch.drop(given)
    return keys, found, sum(words_by_count.values())


def _trained(encoded: DataFrame, words: int, dimension: int, window: int, iterations: int, seed: int, scratch: Scratch) -> DataFrame:
    """``(key, vector)`` of all words, from the slices' rows."""
    slices, vectors = encoded.agg(F.max("slice") + 1, F.sum("vectors")).first()
    slices, vectors = slices or 1, vectors or 0
    cores = encoded.sparkSession.sparkContext.defaultParallelism
    wide = cores * max(1, int(WAVE_BYTES // (cores * max(1, vectors / slices * dimension * 2))))
    waves = [(first, min(first + wide, slices)) for first in range(0, slices, wide)]
    # A bucket has its part of what a wave sends, and of all words and inner nodes.
    most = encoded.groupBy(F.floor(F.col("slice") / wide)).agg(F.sum("vectors").alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = max(1, cores, ceil((most + 2 * words) * dimension * 4 / BUCKET_BYTES))
    small = len(waves) == 1 and vectors * dimension * 4 <= BUCKET_BYTES
    model, kept, last = None, [], iterations - 1
    for number in range(iterations):
        sums, kind = None, _kind(number, iterations)
        for first, end in waves:
            own = encoded.filter(F.col("slice").between(first, end - 1))
            if model is None:
                given = own.withColumns({"keys": F.lit(None).cast("binary"), "matrix": F.lit(None).cast("binary")})
            else:
                asked = own.select("slice", "words").mapInArrow(_asked(buckets), TRAINED.replace(", matrix binary", ""))
                asked = asked.repartition(buckets, "bucket").groupBy("bucket")
                answered = model.groupBy("bucket").cogroup(asked).applyInArrow(_answered, TRAINED)
                given = own.unionByName(answered.drop("bucket"), allowMissingColumns=True)
            # A slice's words come before its vectors, which then need not wait for them.
            given = given.repartitionById(end - first, F.col("slice") - first).sortWithinPartitions(F.col("tokens").isNull())
            trained = given.mapInArrow(_round(dimension, window, number, iterations, buckets, seed), TRAINED)
            # Written by bucket, so that what the slices were given goes before the sums are written.
            trained = trained.repartition(buckets, "bucket") if small else scratch.keep_bucketed(trained, "trained", "bucket", buckets, **LARGE_ROWS)
            dealt = trained.groupBy("bucket")
            over = end == slices
            rows = VECTORS if over and number == last else HELD
            if sums is None:
                added = dealt.applyInArrow(_first_added(dimension, kind, over), rows)
            else:
                added = sums.groupBy("bucket").cogroup(dealt).applyInArrow(_added(dimension, kind, over), rows)
            if rows == VECTORS:
                sums = scratch.keep(added, "vectors", compression="zstd")
            elif small and number % ROUNDS_PER_WRITE != ROUNDS_PER_WRITE - 1:
                sums = added
                continue
            else:
                sums = scratch.keep_bucketed(added, "sums", "bucket", buckets, **LARGE_ROWS)
            if not small:
                scratch.drop(trained)
            # What went into the model that is still asked stays.
            if over:
                while kept:
                    scratch.drop(kept.pop())
            elif len(kept) > (model is not None):
                scratch.drop(kept.pop())
            kept.append(sums)
        model = sums
    return model
