"""Words and word shingles of whole texts, hashed in numpy over Arrow buffers.

A word is a maximal run of bytes other than space and 09-0D. Everything works on
the UTF-8 bytes of a column of texts at once, so no Python string is made.
Hashes are 64-bit: a polynomial over the bytes of a word, then a finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C55)
_ODD = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
_BYTES_AT_ONCE = 1 << 19  # texts worked on together; a longer text is worked on alone

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _ODD[0]
    x ^= x >> np.uint64(27)
    x *= _ODD[1]
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE)])
        _inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, inverse)])
    return _powers[:n], _inverses[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and where each starts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = _BYTES_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes; a row with more is a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def words_of(
    data: np.ndarray, offsets: np.ndarray, lower: bool, blank: np.ndarray = _BLANK
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and per text the number of words before it.

    blank: which bytes separate words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = np.zeros(n + 1, bool)
    np.logical_not(blank[data], out=inside[:n])
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside[:n].copy()
    start[1:] &= ~inside[: n - 1] | edge[1:n]
    end = inside[:n] & (~inside[1:] | edge[1:])
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    up, down = powers(n)
    sums = (_LOWER[data] if lower else data).astype(np.uint64)
    sums += np.uint64(1)
    sums *= up
    np.cumsum(sums, out=sums)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mix((sums[ends] - before) * down[starts]), np.searchsorted(starts, offsets)


def shingles_of(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; with fewer words, of the whole sequence as one."""
    if not len(words):
        return words
    n = min(n, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = mix(total * _ODD[2] + words[k : k + len(total)])
    return total


def shingle_sets(column: pa.Array, n: int, lower: bool = True) -> Iterator[np.ndarray]:
    """For each text in order its distinct shingle hashes, ascending; empty without words."""
    data, offsets = text_bytes(column)
    for first, last in slices(offsets):
        part = offsets[first : last + 1]
        words, at = words_of(data[part[0] : part[-1]], part - part[0], lower)
        total = np.zeros(len(words), np.uint64)
        m = len(words) - n + 1
        if m > 0:
            total = np.zeros(m, np.uint64)
            for k in range(n):
                total = mix(total * _ODD[2] + words[k : k + m])
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a >= n:
                yield np.unique(total[a : b - n + 1])
            else:
                yield shingles_of(words[a:b], n)
