"""Word spans and rolling hashes over Arrow text columns, vectorised with numpy.

All functions work on the UTF-8 bytes of many documents at once. Separators of
words are ASCII, so cutting bytes never cuts a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed in one go; bounds the memory of a Python worker.
CHUNK_BYTES = 4 << 20
_PIECE = 1 << 19
_MULT = 0x9E3779B97F4A7C15
_GRAM = 0xD6E8FEB86659FD93
_M64 = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CACHE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_pair(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    have = _CACHE.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, _PIECE + 64)
        have = _CACHE[base] = (_powers(base, size), _powers(pow(base, -1, 1 << 64), size))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD = ~_SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    arr = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2] or b"", dtype=np.uint8)
    return data, off


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row where a row alone is longer)."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def spans(data: np.ndarray, off: np.ndarray, word: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes of ``data``) of all words, and where each row's words begin.

    ``off`` counts from ``data[0]``. A word never crosses rows.
    """
    w = word[data]
    first = w.copy()
    first[1:] &= ~w[:-1]
    inner = off[(off > 0) & (off < len(data))]
    first[inner] = w[inner]
    last = w.copy()
    last[:-1] &= ~w[1:]
    last[inner - 1] = w[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial over byte codes, from prefix sums."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _PIECE, side="right")))
        stop = ends[j - 1]
        p, inv = _power_pair(_MULT, int(stop - base))
        run = np.empty(stop - base + 1, dtype=np.uint64)
        run[0] = 0
        np.cumsum(_TABLE[data[base:stop]] * p[:stop - base], out=run[1:])
        s = starts[i:j] - base
        out[i:j] = mix((run[ends[i:j] - base] - run[s]) * inv[s])
        i = j
    return out


def gram_hashes(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes (``len(words) - size + 1`` of them)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    w = mix(words ^ np.uint64(salt)) if salt else words
    base = ((_GRAM ^ (salt * _MULT)) & _M64) | 1
    if size <= 8:
        out = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            out = out * np.uint64(base) + w[k:k + n]
        return mix(out)
    out = np.empty(n, dtype=np.uint64)
    p, inv = _power_pair(base, _PIECE + size)
    for lo in range(0, n, _PIECE):
        hi = min(n, lo + _PIECE)
        run = np.empty(hi - lo + size, dtype=np.uint64)
        run[0] = 0
        np.cumsum(w[lo:hi + size - 1] * p[:hi - lo + size - 1], out=run[1:])
        out[lo:hi] = (run[size:size + hi - lo] - run[:hi - lo]) * inv[:hi - lo]
    return mix(out)
