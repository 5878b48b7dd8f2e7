"""Word vectors: training, word arithmetic, nearest words, document vectors.

A vector table is ``(word string, vector array<double>)`` with one row per word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions.tokens import trim_controls
from marginalia.functions.vectors import cosine, distance, opposite
from marginalia.operators.corpus import MIN_COUNT
from marginalia.operators.skew import look_up, shuffle_width
from marginalia.operators.training import train
from marginalia.scratch import Scratch

PARTITIONS = 32
NEAREST = 20

# Equal similarities may differ in their last bits by the order of summation. Sorting on fewer
# digits leaves such ties to the word.
SORT_DIGITS = 9

# A task matches so many queries with so many words at a time, and works out so many
# similarities at once: 16 MiB of doubles, whatever the dimension.
BLOCK_QUERIES = 2_048
SLICE_WORDS = 20_000
TILE = 1 << 21

# Vectors that a task multiplies documents with at a time, and counts it multiplies at once.
BLOCK_BYTES = 64 << 20
MULTIPLIED = 20_000
# Tokens whose documents are counted together, and tokens that meet their vectors in one task.
COUNTED_TOKENS = 2_000_000
MET_TOKENS = 4_000_000

MATCH_SCHEMA = "query_id bigint, word string, similarity double"
NO_MATCHES = pd.DataFrame(
    {"query_id": pd.Series(dtype="int64"), "word": pd.Series(dtype="object"), "similarity": pd.Series(dtype="float64")}
)


def train_word_vectors(
    corpus: DataFrame,
    dimension: int,
    window: int,
    iterations: int,
    partitions: int = PARTITIONS,
    min_count: int = MIN_COUNT,
    seed: int = 1,
) -> DataFrame:
    """Train on ``corpus(tokens)`` and return the vector table as written. Sentences of more than 1,000 words
    are trained in pieces of that length, as Spark's own trainer does by default; unlike there, neither the
    driver nor a task holds the whole model (see ``training``), so the vocabulary may have any size."""
    return train(corpus, dimension, window, iterations, partitions, min_count, seed, Scratch(corpus.sparkSession))


def vector_table(model: DataFrame) -> DataFrame:
    return model.select("word", "vector")


def vocabulary(model: DataFrame) -> DataFrame:
    return model.select("word")


def _zeros(vectors: DataFrame) -> Column:
    """The null vector of the table's dimension."""
    dimension = vectors.select(F.size("vector")).limit(1).scalar()
    return F.array_repeat(F.lit(0.0), dimension)


def word_vector(vectors: DataFrame, word: str) -> DataFrame:
    """``(vector)`` of the word in lower case, or no row."""
    return vectors.filter(F.col("word") == F.lower(F.lit(word))).select("vector")


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, sign, word)`` per term of ``queries(query_id, expr)``.

    Terms are joined by ``+`` and ``-``; blanks around a word and its case do not matter.
    """
    parts = F.regexp_extract_all("expr", F.lit(r"[+-]?[^+-]+"), 0)
    return queries.select("query_id", F.explode(parts).alias("part")).select(
        "query_id",
        F.when(F.startswith("part", F.lit("-")), -1).otherwise(1).alias("sign"),
        F.lower(trim_controls(F.regexp_replace("part", "^[+-]", ""))).alias("word"),
    )


def query_vectors(terms: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(query_id, vector)``: the signed sum of a query's known words; no row without any."""
    known = look_up(terms, vectors, "word")
    signed = F.when(F.col("sign") < 0, opposite(F.col("vector"))).otherwise(F.col("vector"))
    total = Summarizer.sum(array_to_vector(signed))
    return known.groupBy("query_id").agg(vector_to_array(total).alias("vector"))


def synonyms(vectors: DataFrame, target: DataFrame, n: int) -> DataFrame:
    """``(word, similarity)``: the ``n`` words nearest by angle to the one row of
    ``target(vector)``. The word the target comes from is not left out."""
    scored = (
        vectors.withColumn("_target", target.select("vector").scalar())
        .filter(F.col("_target").isNotNull())
        .select("word", cosine(F.col("vector"), F.col("_target")).alias("similarity"))
    )
    return scored.orderBy(F.round("similarity", SORT_DIGITS).desc(), "word").limit(n)


def sum_words(
    vectors: DataFrame, word1: str, word2: str, n: int, minus: bool = False
) -> DataFrame:
    """The words nearest to the sum of two words, or to their difference."""
    spark = vectors.sparkSession
    terms = spark.createDataFrame(
        [(0, 1, word1.lower()), (0, -1 if minus else 1, word2.lower())],
        "query_id bigint, sign int, word string",
    )
    return synonyms(vectors, query_vectors(terms, vectors), n)


def _directions(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; null vectors stay null."""
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def _best_per_query(
    ids: np.ndarray, queries: np.ndarray, words: np.ndarray, vectors: np.ndarray, n: int
) -> pd.DataFrame:
    """The ``n`` best of some words for each of some queries, a tile of queries at a time."""
    queries, vectors = _directions(queries), _directions(vectors)
    rows = max(1, TILE // max(1, len(words)))
    of, found, values = [], [], []
    for start in range(0, len(ids), rows):
        similar = queries[start : start + rows] @ vectors.T
        for q, row in enumerate(similar, start):
            rounded = np.round(row, SORT_DIGITS)
            at = np.arange(len(row))
            if len(row) > n:
                at = np.flatnonzero(rounded >= np.partition(rounded, -n)[-n])
            if len(at) > n:
                at = at[np.lexsort((words[at], -rounded[at]))[:n]]
            of.append(np.full(len(at), ids[q]))
            found.append(words[at])
            values.append(row[at])
    return pd.DataFrame({"query_id": np.concatenate(of), "word": np.concatenate(found), "similarity": np.concatenate(values)})


def _first_per_query(matches: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.round("similarity", SORT_DIGITS).desc(), "word")
    return (
        matches.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= n)
        .select("query_id", "place", "word", "similarity")
    )


def similar_words(queries: DataFrame, vectors: DataFrame, n: int) -> DataFrame:
    """``(query_id, place, word, similarity)``: the ``n`` nearest words of every query vector.

    Blocks of queries meet slices of the words, each pair in one task, which hands on only the
    best words of its slice. A task holds one block, one slice and one tile of similarities.
    Both tables are counted for that while the plan is made, so pass written ones.
    """
    blocks = max(1, ceil(queries.count() / BLOCK_QUERIES))
    slices = max(1, ceil(vectors.count() / SLICE_WORDS))

    def part(key: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    asked = queries.select("query_id", "vector", part("query_id", blocks).alias("block"))
    asked = asked.withColumn("slice", every(slices))
    searched = vectors.select("word", "vector", part("word", slices).alias("slice"))
    searched = searched.withColumn("block", every(blocks))

    def match(asked: pd.DataFrame, searched: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or searched.empty:
            return NO_MATCHES
        return _best_per_query(
            asked["query_id"].to_numpy(),
            np.stack(asked["vector"].to_numpy()),
            searched["word"].to_numpy(),
            np.stack(searched["vector"].to_numpy()),
            n,
        )

    keys = ["block", "slice"]
    matches = asked.groupBy(*keys).cogroup(searched.groupBy(*keys)).applyInPandas(match, MATCH_SCHEMA)
    return _first_per_query(matches, n)


def word_query(queries: DataFrame, vectors: DataFrame, n: int) -> DataFrame:
    """Answer all word-arithmetic queries of ``queries(query_id, expr)`` in one plan.

    Unknown words contribute nothing; a query without any known word has no result.
    """
    return similar_words(query_vectors(query_terms(queries), vectors), vectors, n)


def _packed(numbers: np.ndarray) -> bytes:
    raw = numbers.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), kind)


def _count_words(blocks: int) -> Callable:
    """From ``(doc_id, tokens)`` the counts of a slice of documents by block of words, a row each: the
    ids of its documents, its different words, and which document has which word how often. The row of
    the first block, which is always there, has the documents' lengths too."""

    def lengths_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.nan_to_num(batch.column("tokens").value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Runs of rows with about so many tokens, one row at least; small batches are put together."""
        held, total = [], 0
        for batch in batches:
            ends = np.cumsum(lengths_of(batch))
            first = 0
            while first < batch.num_rows:
                before = int(ends[first - 1]) if first else 0
                last = int(np.searchsorted(ends, before + COUNTED_TOKENS - total, "right"))
                if last == first and held:  # no room for the next row
                    yield pa.Table.from_batches(held)
                    held, total = [], 0
                    continue
                last = max(first + 1, last)
                held.append(batch.slice(first, last - first))
                total += int(ends[last - 1]) - before
                first = last
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(cut(batches)):
            batch = batch.combine_chunks().to_batches()[0]
            sizes = lengths_of(batch)
            docs = np.repeat(np.arange(len(sizes)), sizes)
            found = batch.column("tokens").flatten().dictionary_encode()
            at = found.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            words = np.array(found.dictionary.to_pylist(), object)
            pairs, counts = np.unique(docs[at >= 0] * len(words) + at[at >= 0], return_counts=True)
            docs, at = np.divmod(pairs, max(1, len(words)))
            block_of = np.array([zlib.crc32(w.encode()) % blocks for w in words], np.int64)
            rows = []
            for block in range(blocks):
                own = np.flatnonzero(block_of[at] == block)
                if not block or len(own):
                    used, place = np.unique(at[own], return_inverse=True)
                    lengths = np.maximum(sizes, 1).tolist() if not block else None
                    rows.append((block, (task << 32) | number, 1, words[used].tolist(), _packed(np.diff(docs[own], prepend=0).astype("<i4")), _packed(place.astype("<i4")), _packed(counts[own].astype("<i4")), lengths))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())), strict=True)]
            ids = pa.array([batch.column("doc_id").to_pylist()] * len(rows), pa.list_(batch.schema.field("doc_id").type))
            yield pa.record_batch([*columns, ids], ["block", "slice", "kind", "words", "docs", "at", "counts", "lengths", "ids"])

    return run


def _pack_vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's words and their vectors by slice and block, a row each, in halves where nothing is lost."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = np.array(batch.column("word").to_pylist(), object)
        vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(words), -1)
        with np.errstate(over="ignore"):
            halves = vectors.astype(np.float32)
        if np.array_equal(halves, vectors):
            vectors = halves
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("block", "slice")], axis=1)
        used, of = np.unique(keys, axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        own = np.split(order, np.cumsum(np.bincount(of.ravel()))[:-1])
        columns = [
            pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int64()), pa.array(np.zeros(len(used)), pa.int32()),
            pa.array([words[o].tolist() for o in own], pa.list_(pa.string())), pa.array([_packed(vectors[o]) for o in own], pa.binary()),
            pa.array([vectors.itemsize] * len(used), pa.int32()),
        ]
        yield pa.record_batch(columns, ["block", "slice", "kind", "words", "matrix", "width"])


def _multiply(dimension: int) -> Callable:
    """Counts times vectors, where a slice's vectors come before its counts: partial sums by document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, places, rows, matrix, placed = None, {}, [], None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if (row["block"], row["slice"]) != key:
                    key, places, rows, matrix, placed = (row["block"], row["slice"]), {}, [], None, 0
                if not row["kind"]:
                    places.update(zip(row["words"], range(placed, placed + len(row["words"]))))  # a word may come twice
                    placed += len(row["words"])
                    rows.append(_unpacked(row["matrix"], f"<f{row['width']}").reshape(-1, dimension))
                    continue
                if matrix is None:
                    matrix, rows = np.vstack([*rows, np.zeros((1, dimension))]), None  # unknown words are null
                docs, at, counts = (_unpacked(row[c], "<i4") for c in ("docs", "at", "counts"))
                docs = np.cumsum(docs, dtype=np.int64)
                place = np.array([places.get(w, -1) for w in row["words"]], np.int64)
                sums = np.zeros((len(row["ids"]), dimension))
                for first in range(0, len(docs), MULTIPLIED):  # sorted by document
                    d, part = docs[first : first + MULTIPLIED], slice(first, first + MULTIPLIED)
                    new = np.flatnonzero(np.diff(d, prepend=-1))
                    sums[d[new]] += np.add.reduceat(matrix[place[at[part]]] * counts[part][:, None].astype(np.float64), new, axis=0)
                lengths = row["lengths"] or [0] * len(sums)
                ids = pa.array(row["ids"], batch.schema.field("ids").type.value_type)
                yield pa.record_batch([ids, pa.array(list(sums), pa.list_(pa.float64())), pa.array(lengths, pa.int64())], ["doc_id", "sums", "n"])

    return run


def document_vectors(documents: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(doc_id, vector)`` from ``documents(doc_id, tokens)``: the mean over all tokens, where
    an unknown one counts as the null vector. Rows of one id count as one document.

    A product of a sparse matrix, the words counted by document, with a dense one. The counts are written.
    A slice of them, about ``MET_TOKENS``, gets the vectors of its own words and of no others, in blocks
    where they might be too many for a task, which holds one slice's block. So what is shuffled grows
    with the documents, not with the number of tasks times the vocabulary. The documents are read once;
    pass written vectors, which are counted while the plan is made.
    """
    known = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dimension")).first()
    dimension = known["dimension"] or 0
    if not dimension:
        return documents.select("doc_id").distinct().withColumn("vector", F.array().cast("array<double>"))
    # A slice has fewer different words than tokens; as a rule far fewer than an eighth.
    blocks = max(1, ceil(min(known["n"], MET_TOKENS / 8) * dimension * 8 / BLOCK_BYTES))
    key = documents.schema["doc_id"].dataType.simpleString()
    counted = documents.select("doc_id", "tokens").mapInArrow(
        _count_words(blocks),
        f"block int, slice bigint, kind int, words array<string>, docs binary, at binary, counts binary, lengths array<bigint>, ids array<{key}>",
    )
    # Written, as the words that slices ask for and the counts have to be of the same slices.
    counted = Scratch(documents.sparkSession).keep(counted, "counted")
    full = vectors.filter(F.size("vector") == dimension).select("word", F.col("vector").cast("array<double>").alias("vector"))
    tokens = counted.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda s, x: s + x))).first()[0] or 0
    counted = counted.withColumn("slice", F.pmod(F.xxhash64("slice"), F.lit(max(1, ceil(tokens / MET_TOKENS)))).cast("bigint"))
    given = counted.select("block", "slice", F.explode("words").alias("word")).distinct().join(full, "word")
    given = given.select("block", "slice", "word", "vector").mapInArrow(_pack_vectors, "block int, slice bigint, kind int, words array<string>, matrix binary, width int")
    both = counted.unionByName(given, allowMissingColumns=True)
    both = both.repartition(2 * shuffle_width(documents), "slice", "block").sortWithinPartitions("slice", "block", "kind")  # a number: work, not size, counts
    partial = both.mapInArrow(_multiply(dimension), f"doc_id {key}, sums array<double>, n bigint")
    total = vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")
    summed = partial.groupBy("doc_id").agg(total, F.sum("n").alias("n"))
    return summed.select("doc_id", F.transform("sums", lambda v: v / F.col("n")).alias("vector"))


def nearest_euclid(words: DataFrame, vectors: DataFrame, target: str, n: int = NEAREST) -> DataFrame:
    """``(word, distance)``: the ``n`` of ``words(word)`` nearest to the target word.

    Words without a vector, the target among them, stand at the origin.
    """
    zeros = _zeros(vectors)
    aim = vectors.filter(F.col("word") == F.lit(target)).select("vector").scalar()
    # Worked out where the vectors are, so that distances go through the join and not vectors.
    aimed = vectors.withColumn("_target", F.coalesce(aim, zeros))
    away = aimed.withColumn("_own", F.coalesce("vector", zeros)).select("word", distance(F.col("_own"), F.col("_target")).alias("_away"), F.lit(True).alias("_known"))
    origin = aimed.limit(1).withColumn("_origin", zeros).select(distance(F.col("_origin"), F.col("_target"))).scalar()
    placed = words.join(away, "word", "left").select(
        "word", F.when(F.col("_known"), F.col("_away")).otherwise(origin).alias("distance")
    )
    return placed.orderBy(F.round("distance", SORT_DIGITS), "word").limit(n)
