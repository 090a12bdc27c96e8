"""Texts as numpy arrays: bytes, word bounds and word hashes straight from Arrow's buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that part words, and A-Z in lower case.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Bytes that are hashed at a time.
STEP = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_powers: tuple[np.ndarray, np.ndarray] | None = None


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's bounds in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and each row's bounds among the words. Words end at the end of their row."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edge = at[:-1][at[:-1] < n]
    first[edge] = solid[edge]
    edge = at[1:][at[1:] > 0] - 1
    last[edge] = solid[edge]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, at)


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number modulo 2**64, and those of its inverse."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, STEP)
        up = np.full(size, _ODD, np.uint64)
        down = np.full(size, pow(_ODD, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span; spans are in order of their starts. Equal bytes, equal hashes.

    Sums of bytes times powers of one number over a span, taken as differences of running sums, a block at a time.
    """
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(starts, base + STEP)))
        top = int(ends[lo:hi].max())
        up, down = powers(top - base + 1)
        run = np.zeros(top - base + 1, np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * up[: top - base], out=run[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = mix((run[e] - run[s]) * down[s])
        lo = hi
    return out


def portions(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in portions whose texts have about so many bytes; a longer text is a portion of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(sizes)
    lo = 0
    while lo < batch.num_rows:
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi
