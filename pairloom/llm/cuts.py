"""Words of whole texts by byte spans, worked on in chunks of bounded size.

A text of any length is walked in chunks of about half a megabyte that end between
words, so the memory of a worker follows the chunk and not the text. A chunk never
splits a word; a longer word is a chunk of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .words import mix, powers

_CHUNK = 1 << 19
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass
class Chunk:
    """Part of the joined texts of a column: bytes from `at` on, A-Z lower-cased, and the
    first byte, the end and, if asked for, the 64-bit hash of every word in it."""

    at: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Every word followed by one space, as bytes, and where each word starts."""
        places = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts + 1, out=places[1:])
        letter = np.ones(places[-1], bool)
        letter[places[1:] - 1] = False
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        out = np.full(places[-1], 0x20, np.uint8)
        out[letter] = self.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        return out, places


def _cut(data: np.ndarray, offsets: np.ndarray, first: int, apart: np.ndarray) -> int:
    """The end of the chunk that starts at `first`."""
    end = first + _CHUNK
    if end >= len(data):
        return len(data)
    edge = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
    blanks = np.flatnonzero(apart[data[first:end]])
    best = max(edge, first + int(blanks[-1]) + 1 if len(blanks) else 0)
    if best > first:
        return best
    stop = int(offsets[np.searchsorted(offsets, end, side="right")])  # of the text it lies in
    while end < stop:
        blanks = np.flatnonzero(apart[data[end : end + _CHUNK]])
        if len(blanks):
            return min(end + int(blanks[0]) + 1, stop)
        end += _CHUNK
    return stop


def word_chunks(
    data: np.ndarray, offsets: np.ndarray, apart: np.ndarray, hashed: bool = True
) -> Iterator[Chunk]:
    """Words of joined texts (see `words.text_bytes`) in order, chunk by chunk.

    apart: of each byte value, whether it separates words; texts separate them too.
    """
    first = 0
    while first < len(data):
        last = _cut(data, offsets, first, apart)
        own = _LOWER[data[first:last]]
        n = len(own)
        inside = ~apart[own]
        edges = offsets[np.searchsorted(offsets, first) : np.searchsorted(offsets, last)] - first
        fresh = np.ones(n + 1, bool)  # no word runs over from the byte before
        fresh[1:n] = ~inside[: n - 1]
        fresh[edges] = True
        starts = np.flatnonzero(inside & fresh[:n])
        closed = np.ones(n, bool)
        closed[: n - 1] = ~inside[1:] | fresh[1:n]
        ends = np.flatnonzero(inside & closed) + 1
        if not hashed:
            hashes = np.zeros(0, np.uint64)
        elif n > 2 * _CHUNK:  # one word
            digest = [hashlib.blake2b(own[a:b].tobytes(), digest_size=8).digest() for a, b in zip(starts, ends, strict=True)]
            hashes = np.frombuffer(b"".join(digest), np.uint64)
        else:
            up, down = powers(n)
            sums = own.astype(np.uint64)
            sums += np.uint64(1)
            sums *= up
            np.cumsum(sums, out=sums)
            before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
            hashes = mix((sums[ends - 1] - before) * down[starts]) if len(starts) else np.zeros(0, np.uint64)
        yield Chunk(first, own, starts, ends, hashes)
        first = last


def as_strings(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The byte ranges of data as an Arrow column of texts; ranges may overlap."""
    sizes = stops - starts
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    from_ = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    parts = pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[from_]))
    return pa.LargeStringArray.from_buffers(len(sizes), *parts)
