"""An FM-index over a sequence of word ids, in numpy.

The suffix array is sorted by prefix doubling (only positions that still tie
are sorted again), the last column of the sorted rotations is kept in a
wavelet matrix with popcount ranks, and every ``SAMPLE``-th suffix position
is kept for locating. All queries are vectorised over patterns or rows.

Symbol 0 ends a document. Each end is smaller than every word and different
from the others, so no match and no tie goes beyond a document.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 32
#: Two ranks and a position share 63 bits of a sort key.
_FIELD = 21
MAX_LEN = 1 << _FIELD


class BitVector:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, sigma: int):
        self.shifts = range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1)
        self.levels: list[tuple[BitVector, int]] = []
        for s in self.shifts:
            one = (symbols >> s & 1).astype(bool)
            self.levels.append((BitVector(one), int(len(one) - one.sum())))
            symbols = np.concatenate([symbols[~one], symbols[one]])
        self.first = self._follow(np.arange(sigma), np.zeros(sigma, np.int64))

    def _follow(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for s, (bits, zeros) in zip(self.shifts, self.levels):
            ones = bits.rank(i)
            i = np.where(symbol >> s & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often the symbol stands before place i."""
        return self._follow(symbol, i) - self.first[symbol]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place i, and its rank there."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in self.levels:
            bit, ones = bits.get(i), bits.rank(i)
            symbol = symbol << 1 | bit
            i = np.where(bit, zeros + ones, i - ones)
        return symbol, i - self.first[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order; the text ends with 0, and zeros differ by place."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    if n >= MAX_LEN:
        raise ValueError(f"{n} symbols; an index takes fewer than {MAX_LEN}")
    low = np.int64(MAX_LEN - 1)
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.int64)
    order, slots, todo, k = np.zeros(n, np.int64), np.arange(n), np.arange(n), 1
    while True:
        ahead = np.minimum(todo + k, n - 1)  # past an end only where that end has decided
        key = np.sort(rank[todo] << (2 * _FIELD) | rank[ahead] << _FIELD | todo)
        todo = key & low
        order[slots] = todo
        key >>= _FIELD
        new = np.empty(len(key), bool)
        new[:1], new[1:] = True, key[1:] != key[:-1]
        if k == 1:  # ranks become places in the order
            first = np.flatnonzero(new)
        else:
            first = slots[new]
        rank[todo] = first[np.cumsum(new) - 1]
        alone = new.copy()
        alone[:-1] &= new[1:]
        if alone.all():
            return order
        todo, slots, k = todo[~alone], slots[~alone], 2 * k


class FmIndex:
    def __init__(self, text: np.ndarray, sigma: int, sample: int = SAMPLE):
        """text: ids below sigma; 0 ends each document."""
        order = suffix_array(text)
        before = text[order - 1] if len(text) else text
        self.n, self.starts = len(text), np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.last = WaveletMatrix(before.astype(np.int64), sigma)
        kept = (order % sample == 0) | (before == 0)
        self.kept, self.places = BitVector(kept), order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each pattern (a row of ids)."""
        count, width = patterns.shape
        lo, hi = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        live = np.arange(count)
        for step in range(width - 1, -1, -1):
            symbol = patterns[live, step]
            both = self.last.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]]))
            lo[live], hi[live] = self.starts[symbol] + both[:len(live)], self.starts[symbol] + both[len(live):]
            live = live[lo[live] < hi[live]]
        found = np.zeros(count, bool)
        found[live] = True
        return np.where(found, lo, 0), np.where(found, hi, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by stepping back to a kept one."""
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        rows = rows.copy()
        while len(todo):
            hit = self.kept.get(rows).astype(bool)
            out[todo[hit]] = self.places[self.kept.rank(rows[hit])] + steps
            todo, rows = todo[~hit], rows[~hit]
            symbol, rank = self.last.access_rank(rows)
            rows, steps = self.starts[symbol] + rank, steps + 1
        return out
