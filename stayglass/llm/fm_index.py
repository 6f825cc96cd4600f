"""FM-index over a sequence of small integers: suffix array, Burrows-Wheeler transform, wavelet matrix, samples.

Searches are vectorised over phrases: all phrases take their next backward step at once.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; after each round only suffixes that still tie are sorted again. The last symbol must be
    smaller than all others."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = _ranks(symbols[order], order, n)
    open_ = _tied(rank, order)
    width = 1
    while len(open_):
        places = open_  # places in `order` whose suffixes tie with a neighbour
        suffix = order[places]
        after = suffix + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[suffix]
        by = np.lexsort((second, first))
        suffix, first, second = suffix[by], first[by], second[by]
        order[places] = suffix  # places ascend, and so do the groups that `first` names
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[suffix] = np.maximum.accumulate(np.where(new, places, 0))
        open_ = places[~(new & np.r_[new[1:], True])]
        width *= 2
    return order


def _ranks(sorted_values: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    new = np.r_[True, sorted_values[1:] != sorted_values[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return rank


def _tied(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    r = rank[order]
    new = np.r_[True, r[1:] != r[:-1]]
    return np.flatnonzero(~(new & np.r_[new[1:], True]))


class WaveletMatrix:
    """Rank of any symbol in any prefix, one bit plane after the other."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often the symbol stands before ``end``."""
        begin = np.zeros_like(end)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            one = ((symbol >> level) & 1).astype(bool)
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - begin


class FMIndex:
    """``symbols`` are at least 1; the index adds the end mark 0. Every ``step``-th text position is sampled."""

    def __init__(self, symbols: np.ndarray, step: int = 16):
        text = np.r_[symbols.astype(np.int64), 0]
        order = suffix_array(text)
        self.last = text[order - 1]
        counts = np.bincount(text)
        self.before = np.r_[0, np.cumsum(counts)].astype(np.int64)
        self.matrix = WaveletMatrix(self.last)
        self.sampled = order % step == 0
        self.sample_rank = np.r_[0, np.cumsum(self.sampled)].astype(np.int64)
        self.samples = order[self.sampled]
        self.size = len(text)

    def _step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.matrix.rank(symbol, row)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and row after the last for each phrase. ``phrases`` is padded to the right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        at = lengths.copy()
        live = np.flatnonzero(lengths > 0)
        while len(live):
            at[live] -= 1
            symbol = phrases[live, at[live]]
            known = symbol < len(self.before) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live], high[live] = self._step(symbol, low[live]), self._step(symbol, high[live])
            live = live[(low[live] < high[live]) & (at[live] > 0)]
        high[lengths == 0] = 0
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back through the text to the next sample."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            symbol = self.last[rows[open_]]
            rows[open_] = self._step(symbol, rows[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.samples[self.sample_rank[rows]] + steps
