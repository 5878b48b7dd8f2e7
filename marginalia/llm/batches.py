"""Arrow batches as numpy arrays, in pieces of bounded size."""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column in one array, and where each value starts and ends.

    A null counts as empty.
    """
    kind = pa.string() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.binary()
    column = column.cast(kind)
    if column.null_count:
        column = column.fill_null("" if kind == pa.string() else b"")
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give freed memory back to the system: a worker serves many tasks, and its executor has a limit."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``most`` bytes in ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = as_bytes(batch.column(column))[1]
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
    release()


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start, start + 1, …`` for each start, ``size`` numbers long, one after the other."""
    total = int(sizes.sum())
    before = np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.arange(total, dtype=np.int64) - before + np.repeat(starts, sizes)


def pieces(data: np.ndarray, at: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs outside ``gap`` that cross no text: where they start and end, and their text."""
    inside = ~gap
    starts = inside & np.r_[True, gap[:-1]]
    starts[at[:-1][at[:-1] < len(data)]] = inside[at[:-1][at[:-1] < len(data)]]
    first = np.flatnonzero(starts)
    ends = inside & np.r_[gap[1:], True]
    last = at[1:][(at[1:] > 0)] - 1
    ends[last] |= inside[last]
    return first, np.flatnonzero(ends) + 1, np.searchsorted(at, first, "right") - 1


def sequence_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``data[first:end]`` for each pair: prefix sums of a polynomial, scrambled."""
    base = 0x9E3779B97F4A7C15
    up = np.full(len(data) + 1, base, np.uint64)
    down = np.full(len(data) + 1, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(np.arange(256), 5)[data] * up[:-1], dtype=np.uint64, out=sums[1:])
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))
