"""Compressed full-text index over words: wavelet matrix, backward search, locate.

The text is an array of symbols; 0 separates passages and never matches.
Suffixes are ordered up to their separator (ties by place), so the order takes
about log2(longest passage) rounds of prefix doubling.  The transform is kept as
bit planes of a wavelet matrix with 64-bit blocks and block counts; of the
suffix array only every ``rate``-th place and the first place of each passage
is kept, all other places are found by walking backward through the transform.
All searches are vectorised over many patterns.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence, one packed bit plane per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.size = len(symbols)
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.blocks, self.before, self.zeros = [], [], []
        rest = symbols.astype(np.int64)
        for level in reversed(range(self.bits)):
            ones = (rest >> level) & 1 == 1
            packed = np.zeros((self.size // 64 + 1) * 64, np.uint8)
            packed[:self.size] = ones
            words = np.packbits(packed, bitorder="little").view(np.uint64)
            count = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=count[1:])
            self.blocks.append(words)
            self.before.append(count)
            self.zeros.append(self.size - int(count[-1]))
            rest = np.concatenate([rest[~ones], rest[ones]])
        self.heads = self._descend(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[k][block] + np.bitwise_count(self.blocks[k][block] & low)

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.bits):
            ones = self._ones(k, at)
            up = (symbols >> (self.bits - 1 - k)) & 1 == 1
            at = np.where(up, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(symbols, at) - self.heads[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its rank there."""
        symbols = np.zeros(len(at), np.int64)
        for k in range(self.bits):
            bit = (self.blocks[k][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(k, at)
            at = np.where(bit, self.zeros[k] + ones, at - ones)
            symbols = symbols * 2 + bit
        return symbols, at - self.heads[symbols]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places by the order of their suffixes; a suffix ends at its separator."""
    n = len(text)
    breaks = text == 0
    sep = int(breaks.sum())
    rank = np.where(breaks, np.cumsum(breaks) - 1, text.astype(np.int64) + sep)
    wide = n.bit_length()
    place = np.arange(n, dtype=np.uint64)

    def ordered(key: np.ndarray, bits: int) -> np.ndarray:
        if bits + wide <= 64:  # key and place fit one word: sort values, which is faster than an argsort
            packed = np.sort(key.astype(np.uint64) << np.uint64(wide) | place)
            return (packed & np.uint64((1 << wide) - 1)).astype(np.int64)
        return np.argsort(key, kind="stable")

    order = ordered(rank, int(rank.max(initial=0)).bit_length())
    step = 0
    while True:
        if step == 0:
            key = rank
        new = np.zeros(n, np.int64)
        sorted_key = key[order]
        fresh = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) if n else np.zeros(0, bool)
        new[order] = np.cumsum(fresh) - 1
        top = int(fresh.sum())
        if top == n:
            return order
        rank = new
        step = max(1, step * 2)
        follow = np.zeros(n, np.int64)
        follow[:n - step] = rank[step:] + 1
        key = rank * (top + 1) + follow
        order = ordered(key, (top * (top + 1) + top).bit_length())


class FMIndex:
    """Index of one shard.  ``text`` ends with a separator; symbols are 0 .. alphabet - 1."""

    def __init__(self, text: np.ndarray, alphabet: int, rate: int = 8):
        self.text_size = len(text)
        order = suffix_order(text)
        self.transform = WaveletMatrix(text[order - 1], alphabet)
        sep = int((text == 0).sum())
        count = np.bincount(text, minlength=alphabet)
        count[0] = sep
        self.less = np.concatenate([[0], np.cumsum(count)[:-1]])
        heads = np.concatenate([[True], text[:-1] == 0])
        kept = (heads | (np.arange(len(text)) % rate == 0))[order]
        self._sampled = WaveletMatrix(kept.astype(np.int64), 2)
        self._places = order[kept]
        self.order = order  # dropped by ``compress``

    def compress(self) -> FMIndex:
        """Forget the whole suffix array; places come from the sample from now on."""
        self.order = None
        return self

    def everything(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(n, np.int64), np.full(n, self.text_size, np.int64)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with a symbol and go on as the rows ``low .. high``."""
        at = self.transform.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        base = self.less[symbols]
        return base + at[:len(low)], base + at[len(low):]

    def search(self, symbols: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each pattern; pattern ``i`` is the ``sizes[i]`` symbols before ``ends[i]``."""
        low, high = self.everything(len(ends))
        live = np.arange(len(ends))
        k = 1
        while len(live):
            low[live], high[live] = self.extend(symbols[ends[live] - k], low[live], high[live])
            live = live[(high[live] > low[live]) & (sizes[live] > k)]
            k += 1
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text places of rows, by walking back to the next kept place."""
        out = np.full(len(rows), -1, np.int64)
        live, walked = np.arange(len(rows)), 0
        at = rows.astype(np.int64).copy()
        while len(live):
            kept, rank = self._sampled.access(at[live])
            hit = kept == 1
            out[live[hit]] = self._places[rank[hit]] + walked
            live = live[~hit]
            symbol, rank = self.transform.access(at[live])
            at[live] = self.less[symbol] + rank
            walked += 1
        return out
