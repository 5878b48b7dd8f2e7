"""Byte-level BPE encoding and decoding by a shuffle of distinct words.

The pattern cuts every text into pre-tokens, and the merges never cross them, so each distinct
pre-token needs to be encoded once. A task gives the words of a bounded run of documents codes
by first occurrence and keeps their positions as the row of codes; only the distinct words of
the run are shuffled. Equal words of all runs meet in one task, which encodes and decodes each
once and hands ids and bytes back to the runs, where the codes put them in place.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import ragged, slices
from marginalia.llm.tables import pick, shuffle_width
from marginalia.scratch import Scratch

RUN_BYTES = 16 << 20

RUNS = (
    "run string, docs array<bigint>, sizes array<int>, codes binary,"
    " parts array<struct<part:int,codes:binary,words:binary>>"
)
END = b"\0\n\0"  # between words; no pre-token holds it, as line ends and others never share one


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_bytes(path: str) -> list[tuple[int, bytes]]:
    """``(id, bytes)`` of every token, from a file of ranks."""
    with open(path, "rb") as lines:
        return [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines)]


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _cut(pattern: str, most: int, width: int):
    """Documents to runs of documents: the codes of the words in order, and each word once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        task, number, seen = None, 0, 0
        docs, sizes, codes, words = [], [], [], {}

        def close() -> pa.RecordBatch:
            flat = np.concatenate(codes).astype("<i4")
            by_part = [[] for _ in range(width)]
            for word in sorted(words):
                by_part[crc32(word.encode()) % width].append(word)
            parts = [
                {
                    "part": part,
                    "codes": _pack(np.array([words[w] for w in some], "<i4").tobytes()),
                    "words": _pack(END.join(w.encode() for w in some)),
                }
                for part, some in enumerate(by_part)
                if some
            ]
            row = {"run": f"{task}_{number}", "docs": docs, "sizes": sizes, "codes": _pack(flat.tobytes()), "parts": parts}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in slices(batches, "text"):
            for doc, text, task in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "task")), strict=True):
                found = find(text or "")
                for word in found:
                    if word not in words:
                        words[word] = len(words)
                codes.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
                docs.append(doc)
                sizes.append(len(found))
                seen += len(text or "")
                if seen > most:
                    yield close()
                    number, seen = number + 1, 0
                    docs, sizes, codes, words = [], [], [], {}
        if docs:
            yield close()

    binary = pa.binary()
    part = pa.list_(pa.struct([("part", pa.int32()), ("codes", binary), ("words", binary)]))
    schema = pa.schema(
        [("run", pa.string()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("codes", binary), ("parts", part)]
    )
    return run


def _encode_words(path: str, pattern: str):
    """The words of one part, from all runs: each distinct one is encoded once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, known = _encoding(path, pattern), {}
        for batch in batches:
            for name, part, words in zip(*(batch.column(c).to_pylist() for c in ("run", "part", "words")), strict=True):
                ids = []
                for word in _unpack(words).split(END):
                    found = known.get(word)
                    if found is None:
                        found = known[word] = np.array(encoding._encode_single_piece(word), "<i4").tobytes()
                    ids.append(found)
                sizes = np.array([len(x) // 4 for x in ids], "<i4").tobytes()
                row = [[name], [part], [_pack(sizes)], [_pack(b"".join(ids))]]
                kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], ["run", "part", "sizes", "ids"])

    return run


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(_unpack(packed), "<i4").astype(np.int64)


def _assemble(tokens: dict[int, bytes], digest: bool):
    """A run's codes and its words' ids to the ids of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        lengths = np.array([len(t) for t in table], np.int64)
        starts, bytes_of = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(table), np.uint8)
        decimal = np.array([str(i) for i in range(len(table))], object)
        for row in (row for batch in batches for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows))):
            of_part = {p["part"]: _numbers(p["codes"]) for p in row["parts"]}
            found = [(of_part[p["part"]], _numbers(p["sizes"]), _numbers(p["ids"])) for p in row["encoded"] or []]
            count = sum(len(c) for c in of_part.values())
            at, size, flat, before = np.zeros(count, np.int64), np.zeros(count, np.int64), [], 0
            for codes, sizes, ids in found:
                at[codes], size[codes] = before + np.cumsum(sizes) - sizes, sizes
                flat.append(ids)
                before += len(ids)
            flat = np.concatenate(flat) if flat else np.zeros(0, np.int64)
            codes = _numbers(row["codes"])
            first = np.r_[0, np.cumsum(np.array(row["sizes"], np.int64))]
            out = []
            for i, doc in enumerate(row["docs"]):
                words = codes[first[i] : first[i + 1]]
                ids = flat[ragged(at[words], size[words])]
                text = bytes_of[ragged(starts[ids], lengths[ids])].tobytes()
                if digest:
                    written = ",".join(decimal[ids])
                    out.append((doc, len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(text).hexdigest()))
                else:
                    out.append((doc, ids.tolist(), text))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()] if digest else [pa.int64(), pa.list_(pa.int32()), pa.binary()]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def encode_documents(
    documents: DataFrame, ranks_path: str, pattern: str, scratch: Scratch, digest: bool = False, run_bytes: int = RUN_BYTES
) -> DataFrame:
    """``(doc_id, ids, decoded)`` for every row of ``documents(doc_id, text)``.

    ``digest`` returns ``n_tokens, ids_sha256, decoded_sha256`` instead. A null text is empty and
    has no ids; a null id stays null; a repeated row comes back as often as it is there. Special
    tokens are ordinary text. ``decoded`` comes from the token-byte table by id. A run holds
    about ``run_bytes`` of text, or one longer document.
    """
    width = shuffle_width(documents)
    located = documents.select("doc_id", "text", F.spark_partition_id().alias("task"))
    runs = scratch.keep_bucketed(located.mapInArrow(_cut(pattern, run_bytes, width), RUNS), "runs", "run", width, compression="none")
    encoded = (
        runs.select("run", F.inline("parts")).select("run", "part", "words")
        .repartition(width, "part")
        .mapInArrow(_encode_words(ranks_path, pattern), "run string, part int, sizes binary, ids binary")
        .groupBy("run")
        .agg(F.collect_list(F.struct("part", "sizes", "ids")).alias("encoded"))
    )
    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<int>, decoded binary"
    return runs.join(encoded, "run", "left").mapInArrow(_assemble(dict(token_bytes(ranks_path)), digest), out)


def document_tokens(documents: DataFrame, ranks_path: str, pattern: str, scratch: Scratch) -> DataFrame:
    """Number and digests of the ids of every document, and of the bytes they decode to."""
    return encode_documents(pick(documents, doc_id="doc_id", text="text"), ranks_path, pattern, scratch, digest=True)
