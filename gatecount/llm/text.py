"""Vectorised text helpers that read Arrow string buffers without Python strings.

Every function works on the UTF-8 bytes of a whole Arrow batch at once. Batches are
cut at row borders into pieces of about a megabyte, so the memory in use does not
follow the batch; a single longer text makes one longer piece.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: The six ASCII white-space bytes 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Byte table that lower-cases A-Z and leaves every other byte.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _trim = None

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash base and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[k] = np.cumprod(step, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every bit of a 64-bit value (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def give_back() -> None:
    """Returns freed memory to the system: Python workers stay for later stages, and would keep it beside what those need."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, at, data = column.buffers()
    offsets = np.zeros(1, np.int64)
    if len(column):
        offsets = np.frombuffer(at, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def pieces(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of whole rows of about ``limit`` bytes."""
    data, offsets = buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(rows, max(end, row + 1))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of bytes outside ``gap``; rows never share a run.

    ``gap`` is a table over the 256 byte values, or a mask as long as ``data``.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~gap[data] if len(gap) == 256 else ~gap
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < offsets[1:]]  # where a text that is not empty begins
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tail = cut[1:] - 1
    last[tail] = inside[tail]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal bytes give equal hashes anywhere."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _powers_to(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of ``width`` words; a row with fewer words gives its whole sequence once."""
    salts = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    n = len(hashes)
    count = np.bincount(rows, minlength=n_rows) if n else np.zeros(n_rows, np.int64)
    out_hash, out_row = [], []
    if n >= width:
        same = rows[: n - width + 1] == rows[width - 1 :]
        total = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            total += hashes[k : n - width + 1 + k] * salts[k]
        out_hash.append(mix(total[same]))
        out_row.append(rows[: n - width + 1][same])
    short = (count > 0) & (count < width)
    if short.any():
        begin = np.concatenate([[0], np.cumsum(count)[:-1]])
        total = np.zeros(n_rows, np.uint64)
        for k in range(width - 1):
            has = short & (count > k)
            total[has] += hashes[begin[has] + k] * salts[k]
        total += count.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        out_hash.append(mix(total[short]))
        out_row.append(np.flatnonzero(short))
    if not out_hash:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_hash), np.concatenate(out_row)


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lengths``, one after the other."""
    total = int(lengths.sum())
    begin = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(total, dtype=np.int64) - begin
