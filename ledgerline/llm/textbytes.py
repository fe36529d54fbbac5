"""Vectorised work on the UTF-8 bytes of many texts at once: words, fingerprints of substrings, chunks of Arrow columns.

A text column arrives in a task as one Arrow buffer, so word splitting and hashing run over whole buffers with numpy and
never over single words in Python.  Fingerprints are 64 bits: a polynomial in an odd base over random byte values, from
prefix sums, so that the fingerprint of any substring costs two look-ups; two different strings share one with a chance
of about 2**-60.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once in a task (a single longer text is taken whole).
CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _random_words(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


#: A random value for each byte, and for each lower-cased byte (A-Z as a-z).
VALUES = _random_words(256, 11)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_VALUES = VALUES[LOWER]

#: Bytes of the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: digits, letters and all of non-ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[65:91] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True
#: Bytes other than ASCII white space.
INK_BYTE = np.ones(256, bool)
INK_BYTE[9:14] = INK_BYTE[32] = False

_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**i (or its inverse modulo 2**64) for i < n, kept by the process."""
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    have = _POWERS.get(inverse)
    if have is None or len(have) < n:
        out = np.ones(1 << max(16, int(n - 1).bit_length()), np.uint64)
        done = 1
        while done < len(out):  # double the known part
            step = _U(pow(base, done, 1 << 64))
            out[done : 2 * done] = out[:done] * step
            done *= 2
        _POWERS[inverse] = have = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def prefix_sums(data: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """h with h[e] - h[s] = sum of values[data[i]] * base**i over s <= i < e."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(len(data)), out=out[1:])
    return out


def fingerprints(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of data[start:end], the same for equal bytes wherever they stand."""
    inv = powers(len(sums), True)
    return mix((sums[end] - sums[start]) * inv[start])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null counts as empty.  offsets has one entry more than rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def _returned() -> None:
    """Gives memory that is free back to the system, where the allocator has a call for it: a worker serves many tasks, one stage
    after another, and would keep what its greediest one needed."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _TRIM = None


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of about `limit` bytes; memory is returned after a column."""
    data, offsets = buffers(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        base = offsets[row]
        yield row, end, data[base : offsets[end]], offsets[row : end + 1] - base
        row = end
    _returned()


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the maximal runs of bytes in `inside` that stay within a text; the words of text i are
    first[i]:first[i + 1]."""
    n = len(data)
    flag = inside[data]
    cut = np.zeros(n + 1, bool)  # where a text begins
    cut[offsets] = True
    open_, close = flag.copy(), flag.copy()
    if n:
        open_[1:] &= ~flag[:-1] | cut[1:n]
        close[:-1] &= ~flag[1:] | cut[1:n]
    start, end = np.flatnonzero(open_), np.flatnonzero(close) + 1
    return start, end, np.searchsorted(start, offsets)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenation of start[i], start[i] + 1, ... (length[i] values each)."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - begin, length)


def owners(first: np.ndarray) -> np.ndarray:
    """For rows i with items first[i]:first[i + 1], the row of each item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
