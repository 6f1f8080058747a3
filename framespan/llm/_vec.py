"""Vectorised word hashing over Arrow text columns: whole batches of UTF-8 bytes, no Python strings."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; one longer text is worked on alone.
CHUNK = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RADIX = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd radix modulo 2**64 and of its inverse."""
    if len(_powers[0]) < n:
        n = max(n, CHUNK + 4096)
        for k, base in enumerate((_RADIX, pow(_RADIX, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: tables that operators keep in a Python worker from task to task
KEPT: list[dict] = []


def release(own: dict | None = None) -> None:
    """Gives memory of a Python worker, which serves one stage after another, back to the machine: what is free, and the
    tables that operators other than the caller have kept."""
    others = [x for x in KEPT if x and x is not own]
    for table in others:
        table.clear()
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column and the offsets of its rows; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, one row at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


@dataclass
class Words:
    """Words of a run of documents: hash, first byte and byte after the last; at[d] to at[d + 1] are document d's."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes, bytes after the last, and word offsets of each document."""
    inside = ~BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    first = np.flatnonzero(start)
    return first, np.flatnonzero(end) + 1, np.searchsorted(first, offsets)


def words(raw: np.ndarray, offsets: np.ndarray, *, lower: bool = True) -> Words:
    """Words of documents raw[offsets[d]:offsets[d + 1]] with 64-bit hashes of their (lower-cased) bytes."""
    first, last, at = spans(raw, offsets)
    if not len(first):
        return Words(np.zeros(0, np.uint64), first, last, at)
    up, down = powers(len(raw) + 1)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    table = _BYTES[LOWER] if lower else _BYTES
    np.cumsum(table[raw] * up[: len(raw)], out=sums[1:])
    value = (sums[last] - sums[first]) * down[first]
    return Words(mix(value + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), first, last, at)


def runs(hashes: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `width` words inside each document, and their offsets by document."""
    sizes = np.maximum(np.diff(at) - width + 1, 0)
    to = np.concatenate([[0], np.cumsum(sizes)])
    first = np.arange(to[-1]) + np.repeat(at[:-1] - to[:-1], sizes)
    value = np.zeros(len(first), np.uint64)
    for k in range(width):
        value = mix(value + hashes[first + k] + np.uint64(k + 1))
    return value, to
