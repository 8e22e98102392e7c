"""A compressed index of word sequences: Burrows-Wheeler transform in a wavelet tree.

All operations work on arrays of queries at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes; symbol 0 ends a sequence, and each of its places is a letter of its own."""
    n = len(text)
    ends = text == 0
    rank = np.empty(n, np.int64)
    count = int(ends.sum())
    rank[ends] = np.arange(count)
    rank[~ends] = text[~ends] + count
    width = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[:-width] = rank[width:]
        key = rank * (n + int(text.max(initial=0)) + 2) + after + 1
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(n, np.int64)
        new[0] = 0
        new[1:] = ordered[1:] != ordered[:-1]
        np.cumsum(new, out=new)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        width *= 2


class WaveletTree:
    """Counts of a symbol before a position; one bit vector a level, zeros before ones."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels = []
        values = symbols.astype(np.uint32)
        for level in range(levels - 1, -1, -1):
            bits = (values >> np.uint32(level)) & np.uint32(1)
            padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
            padded[: len(bits)] = bits
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]]).astype(np.uint32)
            zeros = int(len(bits) - bits.sum())
            self.levels.append((level, words, before, zeros))
            one = bits.astype(bool)
            values = np.concatenate([values[~one], values[one]])
        #: Where the run of each symbol begins below the last level.
        every = np.arange(1 << levels)
        self.starts = self._down(every, np.zeros(len(every), np.int64))[0]

    def _down(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """Follows positions down the levels, along each symbol's bits."""
        moved = list(places)
        for level, words, before, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            for k, at in enumerate(moved):
                word = at >> 6
                mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
                ones = before[word].astype(np.int64) + np.bitwise_count(words[word] & mask)
                moved[k] = np.where(one, zeros + ones, at - ones)
        return moved

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each symbol, how many stand before low and before high."""
        low, high = self._down(symbol, low, high)
        start = self.starts[symbol]
        return low - start, high - start


class FMIndex:
    """Backward search over sequences of symbols 1, 2, ..., each followed by a 0."""

    def __init__(self, text: np.ndarray):
        self.order = suffix_array(text)
        top = int(text.max(initial=0))
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.tree = WaveletTree(text[self.order - 1], max(1, top.bit_length()))

    def matches(self, text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of text[start : start + length], read backwards.

        How many symbols from the end occur twice or more in the index (all: `length`), and
        the interval of suffixes that begin with them. A query whose match has become
        unique is not followed further.
        """
        reached = np.zeros(len(starts), np.int64)
        low, high = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        open_ = np.arange(len(starts))
        for k in range(length - 1, -1, -1):
            symbol = text[starts[open_] + k]
            if k == length - 1:
                a, b = self.less[symbol], self.less[symbol + 1]
            else:
                a, b = self.tree.rank(symbol, low[open_], high[open_])
                a, b = a + self.less[symbol], b + self.less[symbol]
            more = b - a > 1
            open_ = open_[more]
            low[open_], high[open_] = a[more], b[more]
            reached[open_] = length - k
        return reached, low, high

    def first(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest place in the text of each interval of suffixes; equal or disjoint ones."""
        intervals, at = np.unique(low, return_index=True)
        edges = np.stack([intervals, high[at]], 1).reshape(-1)
        least = np.minimum.reduceat(np.append(self.order, np.iinfo(np.int64).max), edges)[::2] if len(edges) else intervals
        return least[np.searchsorted(intervals, low)]
