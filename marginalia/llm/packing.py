"""Hierarchical packing of documents into sequences of several lengths.

Every document goes to the shortest tier its tokens fit into, longer ones fill windows of the
longest tier and leave their end to a shorter one. Each tier is packed on its own; what room a
long window has left at the end is filled from shorter tiers, and the rest of a task becomes
windows of falling powers of two. So padding is left in one window per task at most.
"""

from __future__ import annotations

import base64
import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.batches import slices
from marginalia.llm.tables import pick

TIERS = (1024, 512, 256)
SHORTEST = 16
STEP_TOKENS = 8192
TASK_BITS = 33

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, sequence_length int, step_group long"
)


def _printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: a visible byte stands for
    itself, the others take the characters from 256 on, in order."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file.

    Its ids are those of that library with ``add_special_tokens=False`` (tests compare them), about
    four times as fast. It holds for files whose merges are listed in the order of their ids.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    byte = _printable_bytes()
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding(base64.b16encode(path.encode()).decode(), pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


class Packer:
    """Packs the documents of one task. ``closed`` takes finished sequences as lists of
    ``(document, start, end)`` with their length."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, shortest: int = SHORTEST):
        self.tiers, self.shortest = sorted(tiers, reverse=True), shortest
        self.open = {t: ([], 0) for t in self.tiers}
        self.closed: list[tuple[int, list]] = []

    def add(self, doc: int, size: int) -> None:
        start, longest = 0, self.tiers[0]
        while size - start > longest:  # a long document fills windows of its own
            self.closed.append((longest, [(doc, start, start + longest)]))
            start += longest
        tier = min(t for t in self.tiers if t >= size - start)
        self._put(tier, doc, start, size)

    def _put(self, tier: int, doc: int, start: int, end: int) -> None:
        pieces, used = self.open[tier]
        room = tier - used
        if end - start < room:
            pieces.append((doc, start, end))
            self.open[tier] = (pieces, used + end - start)
            return
        if end - start == room:
            self._close(tier, [*pieces, (doc, start, end)])
            return
        # The piece does not fit. Shorter tiers fill the gap if they have enough at hand;
        # otherwise this piece is cut, and its rest opens the next window.
        fill = self._take_shorter(tier, room)
        if fill:
            self._close(tier, pieces + fill)
            self._put(tier, doc, start, end)
        else:
            self._close(tier, [*pieces, (doc, start, start + room)])
            self.open[tier] = ([], 0)
            self._put(tier, doc, start + room, end)

    def _close(self, tier: int, pieces: list) -> None:
        self.closed.append((tier, pieces))
        self.open[tier] = ([], 0)

    def _take_shorter(self, tier: int, room: int) -> list:
        """Pieces of open shorter windows that fill ``room`` to the last token, or none."""
        for shorter in (t for t in self.tiers if t < tier):
            pieces, used = self.open[shorter]
            if used < room:
                continue
            taken, left, kept = [], room, []
            for doc, start, end in pieces:
                cut = min(left, end - start)
                if cut:
                    taken.append((doc, start, start + cut))
                if cut < end - start:
                    kept.append((doc, start + cut, end))
                left -= cut
            self.open[shorter] = (kept, used - room)
            return taken
        return []

    def finish(self) -> None:
        """The tiers' open windows together become windows of falling powers of two."""
        rest = deque(p for t in self.tiers for p in self.open[t][0])
        total = sum(end - start for _, start, end in rest)
        while total:
            size = min(self.tiers[0], 1 << (total.bit_length() - 1))
            size = min(max(size, self.shortest), total)
            pieces, left = [], size
            while left:
                doc, start, end = rest.popleft()
                cut = min(left, end - start)
                pieces.append((doc, start, start + cut))
                if cut < end - start:
                    rest.appendleft((doc, start + cut, end))
                left -= cut
            self.closed.append((size, pieces))
            total -= size
        self.open = {t: ([], 0) for t in self.tiers}


class _Steps:
    """Groups sequences of one length into steps of equal numbers of tokens."""

    def __init__(self, tokens: int):
        self.tokens, self.used, self.group, self.made = tokens, {}, {}, 0

    def of(self, size: int) -> int:
        used = self.used.get(size, self.tokens)
        if used + size > self.tokens:
            self.group[size], used = self.made, 0
            self.made += 1
        self.used[size] = used + size
        return self.group[size]


def _pack(path: str, pattern: str, end_id: int, tiers: tuple[int, ...], step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, packer, steps = tokenizer(path, pattern), Packer(tiers), _Steps(step)
        names, ids, number, made = {}, {}, 0, 0
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        task = None

        def flush() -> pa.RecordBatch:
            nonlocal made
            rows = []
            for size, pieces in packer.closed:
                group, at = (task << TASK_BITS) + steps.of(size), 0
                for doc, start, end in pieces:
                    part = ids[doc][start:end]
                    rows.append((names[doc], start, end - start, crc32(part.tobytes()), len(ids[doc]), (task << TASK_BITS) + made, at, size, group))
                    at += end - start
                made += 1
            packer.closed.clear()
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            live = {doc for pieces, _ in packer.open.values() for doc, _, _ in pieces}
            for doc in ids.keys() - live:
                del ids[doc], names[doc]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in PIECES.split(", ")]
            )

        for batch in slices(batches, "text"):
            for doc, text, task in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "task")), strict=True):
                names[number] = doc
                ids[number] = np.array([*encoding.encode(text or "", allowed_special="all"), end_id], "<u4")
                packer.add(number, len(ids[number]))
                number += 1
            yield flush()
        packer.finish()
        if packer.closed:
            yield flush()

    return run


def pack_documents(
    documents: DataFrame, tokenizer_path: str, pattern: str, end_id: int = 0, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS
) -> DataFrame:
    """One row per piece of a document in a sequence; see ``PIECES``.

    Each task packs its own rows, so nothing is shuffled, and a lost task packs the same way again.
    A null text is empty and has only the end id; a null id stays null; a repeated row is packed
    again; no rows give no pieces. ``step_group`` names sequences of one length that fill a step
    of ``step_tokens``: equal work for each step, whatever its length.
    """
    located = documents.select("doc_id", "text", F.spark_partition_id().cast("long").alias("task"))
    return located.mapInArrow(_pack(tokenizer_path, pattern, end_id, tiers, step_tokens), PIECES)


def packed(documents: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """The documents packed, whatever other columns they have."""
    return pack_documents(pick(documents, doc_id="doc_id", text="text"), tokenizer_path, pattern)
