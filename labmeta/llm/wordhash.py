"""Words of whole texts as flat arrays of 64-bit hashes, worked through in blocks of bounded bytes.

A word is a run of bytes other than 0x20 and 0x09-0x0D, that is, ``[^\\x20\\x09-\\x0D]+`` of the text in UTF-8.
A block holds whole texts; only a single text longer than the bound makes a larger block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse, modulo 2**64. Those for a block are kept, not those for longer texts."""
    global _powers, _inverses
    if len(_powers) > n:
        return _powers, _inverses
    steps = np.full(max(n, BLOCK_BYTES) + 1, _BASE, np.uint64)
    steps[0] = 1
    powers = np.multiply.accumulate(steps)
    steps[1:] = pow(_BASE, -1, 1 << 64)
    inverses = np.multiply.accumulate(steps)
    if n <= BLOCK_BYTES:
        _powers, _inverses = powers, inverses
    return powers, inverses


def rolled(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``values[start:end]`` for each pair, equal for equal contents at any place."""
    powers, inverses = _tables(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])


@dataclass
class Block:
    """Words of some texts. ``offsets[i]:offsets[i + 1]`` are the words of text ``i``."""

    first: int
    hashes: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def texts(self) -> np.ndarray:
        """The text index of each word, within the block."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words (flat index) of all windows of ``size`` words within one text, and the windows' hashes."""
        n = len(self.hashes)
        starts = np.arange(max(0, n - size + 1))
        ends = np.repeat(self.offsets[1:], self.counts)[: len(starts)]
        starts = starts[starts + size <= ends]
        return starts, rolled(self.hashes, starts, starts + size)


def hash_words(data: np.ndarray, offsets: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and, for each text, where its words begin. ``fold``: A-Z count as a-z."""
    n = len(data)
    word = ~SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = word[heads]
    last = word.copy()
    last[:-1] &= ~word[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
    return rolled((_FOLDED if fold else _TABLE)[data], starts, ends), np.searchsorted(starts, offsets)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its texts; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0]


def runs(lengths: np.ndarray, bound: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose lengths sum to ``bound`` at most, or of one longer item."""
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + bound, side="right")))
        yield first, last
        first = last


def blocks(column: pa.Array, fold: bool = False) -> Iterator[Block]:
    data, offsets = utf8(column)
    for first, last in runs(np.diff(offsets)):
        low, high = offsets[first], offsets[last]
        hashes, words = hash_words(data[low:high], offsets[first : last + 1] - low, fold)
        yield Block(first, hashes, words)
