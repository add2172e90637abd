"""FM-index of a sequence of small integers, built and searched with numpy for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; only suffixes that still tie are sorted again. The last symbol must be smaller than all others and occur once."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    rank = _first_of_run(rank[order], order)
    open_ = order
    step = 1
    while step < n:
        counts = np.bincount(rank, minlength=n)
        open_ = open_[counts[rank[open_]] > 1]
        if not len(open_):
            break
        after = np.minimum(open_ + step, n - 1)  # a tied suffix never reaches past the end, where the unique last symbol is
        key = rank[open_] * n + rank[after]
        turn = np.argsort(key, kind="stable")
        open_, key = open_[turn], key[turn]
        group = key // n  # suffixes of a group of ties stand together, from the group's rank on
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        base = np.repeat(begin, np.diff(np.append(begin, len(group))))
        run = np.repeat(new, np.diff(np.append(new, len(key))))
        rank[open_] = group + run - base
        step *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    return sa


def _first_of_run(sorted_: np.ndarray, order: np.ndarray) -> np.ndarray:
    new = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.repeat(new, np.diff(np.append(new, len(order))))
    return rank


class Wavelet:
    """Wavelet matrix: rank(symbol, position) for arrays of both."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.zeros, self.ones = [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low, high = np.zeros(len(at), np.int64), at.astype(np.int64)
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[k][low].astype(np.int64), self.ones[k][high].astype(np.int64)
            low = np.where(one, self.zeros[k] + a, low - a)
            high = np.where(one, self.zeros[k] + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        at = at.astype(np.int64)
        out = np.zeros(len(at), np.int64)
        for k in range(self.bits):
            ones = self.ones[k]
            bit = ones[at + 1] - ones[at]
            out = (out << 1) | bit
            at = np.where(bit == 1, self.zeros[k] + ones[at], at - ones[at])
        return out


class FMIndex:
    """``text`` holds symbols from 1 on; 0 is kept for the end. Suffix positions are kept where they are multiples of ``sample``."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        text = np.concatenate([text, [0]]).astype(np.int64)
        sa = suffix_array(text)
        self.sample, self.length = sample, len(text)
        self.bwt = Wavelet(text[sa - 1], max(1, int(symbols).bit_length()))
        counts = np.bincount(text, minlength=symbols + 2)
        self.before = np.cumsum(counts) - counts
        marked = sa % sample == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)]).astype(np.int64)
        self.positions = sa[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of rows whose suffixes begin with each pattern, a row of the matrix of which the first ``lengths`` symbols count."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.length, np.int64)
        for back in range(patterns.shape[1]):
            at = lengths - 1 - back
            live = np.flatnonzero((at >= 0) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, at[live]]
            low[live] = self.before[symbol] + self.bwt.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.bwt.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back through the text until a sampled position."""
        rows = rows.astype(np.int64)
        out, walked = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        at = rows.copy()
        while len(live):
            kept = self.marks[at[live] + 1] > self.marks[at[live]]
            done = live[kept]
            out[done] = self.positions[self.marks[at[done]]] + walked[done]
            live = live[~kept]
            symbol = self.bwt.access(at[live])
            at[live] = self.before[symbol] + self.bwt.rank(symbol, at[live])
            walked[live] += 1
        return out
