"""Words of whole texts and their 64-bit hashes, in numpy over the UTF-8 bytes of an Arrow column.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
Texts are taken in chunks of a few MB and hashed in segments, so memory does not grow with the batch; a single text
longer than a chunk makes a chunk of its own.

The hash of a byte string ``b_0 b_1 ...`` is ``sum(T[b_i] * P**i) mod 2**64`` with a table ``T`` of random odd-free
64-bit numbers, finished by an invertible mix. Sums over prefixes then give every word's hash without a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
_SEGMENT = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SEPARATORS)] = False
_FOLDED = np.arange(256, dtype=np.int64)
_FOLDED[65:91] += 32

_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_ALL = _BYTES
_WORD = np.where(IS_WORD, _BYTES, np.uint64(0))
_WORD_FOLDED = np.where(IS_WORD, _BYTES[_FOLDED], np.uint64(0))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS, _INVERSES = _powers(_SEGMENT, _BASE), _powers(_SEGMENT, _INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """An invertible mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def piece_hashes(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hashes of ``data`` cut at ``starts``; bytes with a zero in ``table`` do not count."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        begin = int(starts[first])
        last = max(first + 1, int(np.searchsorted(starts, begin + _SEGMENT, side="right")) - 1)
        if last == len(starts) - 1 and len(data) - begin <= _SEGMENT:
            last = len(starts)
        end = int(starts[last]) if last < len(starts) else len(data)
        powers, inverses = _POWERS, _INVERSES
        if end - begin > _SEGMENT:  # one piece longer than a segment
            powers, inverses = _powers(end - begin, _BASE), _INVERSES
        terms = table[data[begin:end]] * powers[: end - begin]
        at = starts[first:last] - begin
        out[first:last] = np.add.reduceat(terms, at) * inverses[at]
        first = last
    return mix(out)


@dataclass
class Chunk:
    """Some texts of a batch: bytes, where texts begin and end, where their words begin."""

    first: int
    last: int
    data: np.ndarray
    edges: np.ndarray
    starts: np.ndarray
    word_edges: np.ndarray

    def word_hashes(self, fold: bool = True) -> np.ndarray:
        return piece_hashes(self.data, self.starts, _WORD_FOLDED if fold else _WORD)

    def word_counts(self) -> np.ndarray:
        return np.diff(self.word_edges)

    def owner(self) -> np.ndarray:
        """Number of each word's text in the chunk."""
        return np.repeat(np.arange(self.last - self.first), self.word_counts())

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Number of set ``flags`` of the bytes of each text."""
        at = np.flatnonzero(flags)
        return np.diff(np.searchsorted(at, self.edges))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    return offsets, np.frombuffer(held, dtype=np.uint8) if held else np.empty(0, dtype=np.uint8)


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column in order, ``limit`` bytes at a time or one longer text."""
    if len(column) == 0:
        return
    offsets, data = text_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n)
        edges = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        word = IS_WORD[part]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inner = edges[:-1][edges[:-1] < len(part)]
        begins[inner] = word[inner]
        starts = np.flatnonzero(begins)
        yield Chunk(first, last, part, edges, starts, np.searchsorted(starts, edges))
        first = last
