"""Whole texts of an Arrow batch as flat byte blocks, with words and window hashes.

Everything here is a helper for code that runs inside Spark tasks. A block holds the
texts of consecutive rows, up to about `BLOCK` bytes (or one longer text), so memory is
bounded by the block or the longest single text, whatever the size of a batch. Nulls are
empty texts. No function looks at less than the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_U = np.uint64
BASE = _U(0x9E3779B97F4A7C13)  # odd, so powers have an inverse modulo 2**64
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)

#: Bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all bits; a one-to-one map."""
    x = x ^ (x >> _U(30))
    x *= _MIX1
    x ^= x >> _U(27)
    x *= _MIX2
    x ^= x >> _U(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


class _Powers:
    """Powers of `BASE` and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = _U(pow(int(BASE), -1, 1 << 64))
            self.up, self.down = (self._table(b, n) for b in (BASE, inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _table(base: np.uint64, n: int) -> np.ndarray:
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)


_POWERS = _Powers()


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, scale): hash of values[a:b] is (sums[b] - sums[a]) * scale[a], modulo 2**64."""
    up, down = _POWERS.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


@dataclass
class Block:
    """Rows [row, row + len(offsets) - 1) of a batch: bytes and text bounds inside them."""

    row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def text_blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[Block]:
    """Cut a string column into blocks of whole texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:  # else a copy of the whole batch
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield Block(row, flat[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row])
        row = end


@dataclass
class Words:
    """Words of a block in order: byte bounds, 64-bit hashes, and bounds of each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def room(self) -> np.ndarray:
        """For each word, the words from it to the end of its text."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.start))


def word_bounds(block: Block, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    inside = is_word[block.data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = block.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words_of(block: Block, is_word: np.ndarray = IS_WORD, fold: bool = False) -> Words:
    """Words of a block; `fold` reads A-Z as a-z."""
    if fold:
        upper = (block.data >= 65) & (block.data <= 90)
        block = Block(block.row, block.data + (upper.view(np.uint8) << 5), block.offsets)
    start, end = word_bounds(block, is_word)
    sums, scale = prefix_sums(_BYTE_VALUES[block.data])
    hashes = mix((sums[end] - sums[start]) * scale[start])
    return Words(start, end, hashes, np.searchsorted(start, block.offsets))


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start words and hashes of all runs of `size` words inside one text."""
    at = np.flatnonzero(words.room() >= size)
    if size <= 8:
        h = words.hash[at]
        for k in range(1, size):
            h = h * BASE + words.hash[at + k]
        return at, mix(h)
    sums, scale = prefix_sums(words.hash)
    return at, mix((sums[at + size] - sums[at]) * scale[at])


def covered_ranges(first: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges [first, end)."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, np.minimum(end, n), -1)
    return np.cumsum(steps[:-1]) > 0


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of `size` that begins at one of `starts`."""
    return covered_ranges(starts, starts + size, n)
