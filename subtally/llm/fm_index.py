"""A full-text index of a shard of symbol runs: BWT, wavelet matrix, sampled positions.

Runs inside Spark tasks on bounded shards. A shard is a row of runs of 64-bit words, laid
one after the other with a stop behind each. Its suffixes are ordered by prefix doubling; all
stops differ there, so no comparison goes beyond a run. The symbols before the suffixes in
that order (the Burrows-Wheeler transform) are kept as a wavelet matrix, one bit array with
counts per bit of the symbol, which answers "how often does c occur before place i" for many
c and i at once. Positions are kept for every `STEP`-th symbol of a run, the first included;
an occurrence walks back to the next of them and never leaves its run.
"""

from __future__ import annotations

import numpy as np

#: Every so many symbols of a run have their position stored.
STEP = 16
#: Most occurrences that are located at once.
_CHUNK = 1 << 18
_STOP = 0


class Bits:
    """A bit array that counts its ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones in [0, at) for each place."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0


class Wavelet:
    """A wavelet matrix over symbols 0 .. size - 1."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for level in range(max(size - 1, 1).bit_length() - 1, -1, -1):
            bits = (symbols >> level) & 1 > 0
            zeros = int(len(bits) - bits.sum())
            self.levels.append((level, Bits(bits), zeros))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        self.starts = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbol, at) - self.starts[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol = np.zeros(len(at), np.int64)
        for level, bits, zeros in self.levels:
            one, ones = bits[at], bits.ones(at)
            at = np.where(one, zeros + ones, at - ones)
            symbol |= one.astype(np.int64) << level
        return symbol, at - self.starts[symbol]


def suffix_order(symbols: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes; `stops` are places, each of its own rank."""
    n = len(symbols)
    keys = symbols.astype(np.int64) + len(stops)
    keys[stops] = np.arange(len(stops))
    rank = np.unique(keys, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        order = np.argsort(rank, kind="stable")
        sorted_rank = rank[order]
        tied = np.zeros(n, bool)
        same = sorted_rank[1:] == sorted_rank[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        if not tied.any():
            return order
        # Only places that still tie are looked at again, by the rank that follows them.
        places = order[tied]
        following = rank[np.minimum(places + width, n - 1)]
        finer = np.lexsort((following, sorted_rank[tied]))
        new = np.flatnonzero(tied)
        places, following = places[finer], following[finer]
        group = sorted_rank[tied]
        differs = np.ones(len(places), bool)
        differs[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        # A rank is the first place of its group in the order, so that finer ones fit between.
        head = np.maximum.accumulate(np.where(differs, new, 0))
        rank = rank.copy()
        full = np.arange(n)
        full[1:][same] = 0
        rank[order] = np.maximum.accumulate(full)
        rank[places] = head
        width *= 2


class FMIndex:
    """Runs of 64-bit words, searchable backwards."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        """`bounds` of the runs in `words`: run i is words[bounds[i]:bounds[i + 1]]."""
        lengths = np.diff(bounds)
        runs, n = len(lengths), len(words) + len(lengths)
        self.begins = bounds[:-1] + np.arange(runs)
        stops = self.begins + lengths
        is_word = np.ones(n, bool)
        is_word[stops] = False
        self.dictionary, ids = np.unique(words, return_inverse=True)
        symbols = np.zeros(n, np.int64)
        symbols[is_word] = ids + 1
        size = len(self.dictionary) + 1
        order = suffix_order(symbols, stops)
        self.wavelet = Wavelet(symbols[order - 1], size)  # the last place is a stop
        self.first = np.zeros(size + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=size), out=self.first[1:])
        within = np.arange(n) - np.repeat(self.begins, lengths + 1)
        sampled = (within % STEP == 0)[order]
        self.sampled = Bits(sampled)
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds in the suffix order of the places that begin with each row of `phrases`."""
        place = np.searchsorted(self.dictionary, phrases)
        known = np.minimum(place, len(self.dictionary) - 1)
        alive = np.flatnonzero((self.dictionary[known] == phrases).all(axis=1))
        low = np.zeros(len(phrases), np.int64)
        high = np.zeros(len(phrases), np.int64)
        symbols = place[alive] + 1
        lo, hi = self.first[symbols[:, -1]], self.first[symbols[:, -1] + 1]
        for k in range(phrases.shape[1] - 2, -1, -1):
            some = lo < hi
            alive, symbols, lo, hi = alive[some], symbols[some], lo[some], hi[some]
            c = symbols[:, k]
            lo = self.first[c] + self.wavelet.rank(c, lo)
            hi = self.first[c] + self.wavelet.rank(c, hi)
        low[alive], high[alive] = lo, hi
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in these rows of the order."""
        found = np.empty(len(rows), np.int64)
        for begin in range(0, len(rows), _CHUNK):
            at, waiting = rows[begin : begin + _CHUNK].copy(), np.arange(len(rows[begin : begin + _CHUNK]))
            steps = 0
            while len(waiting):
                here = self.sampled[at]
                found[begin + waiting[here]] = self.positions[self.sampled.ones(at[here])] + steps
                waiting, at = waiting[~here], at[~here]
                symbol, before = self.wavelet.access(at)
                at = self.first[symbol] + before
                steps += 1
        return found

    def run_of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the run of each place, and the place inside it."""
        run = np.searchsorted(self.begins, places, "right") - 1
        return run, places - self.begins[run]
