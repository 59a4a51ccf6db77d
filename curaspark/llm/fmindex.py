"""An FM-index over integers in numpy: suffix array, wavelet matrix of the transform, sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of seq in order, by prefix doubling. seq ends in a symbol that occurs nowhere else and
    is the smallest."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    sorted_ = seq[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate(([False], sorted_[1:] != sorted_[:-1])))
    k = 1
    while rank[order[-1]] < n - 1:
        key = rank * (n + 1)
        key[: n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([False], sorted_[1:] != sorted_[:-1])))
        k *= 2
    return order


class WaveletMatrix:
    """Ranks and symbols of a sequence of non-negative integers, a bit level at a time."""

    def __init__(self, seq: np.ndarray):
        self.bits = max(1, int(seq.max(initial=0)).bit_length())
        self.zeros: list[int] = []
        #: For each level, how many 0 bits come before each position.
        self.before: list[np.ndarray] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (seq >> level) & 1
            self.before.append(np.concatenate(([0], np.cumsum(bit == 0))).astype(np.int32))
            self.zeros.append(int(self.before[-1][-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low = np.zeros(len(at), np.int64)
        at = at.astype(np.int64)
        for i, (zeros, before) in enumerate(zip(self.zeros, self.before)):
            one = (symbol >> (self.bits - 1 - i)) & 1 == 1
            low0, at0 = before[low], before[at]
            low = np.where(one, zeros + low - low0, low0)
            at = np.where(one, zeros + at - at0, at0)
        return np.where(symbol >> self.bits, 0, at - low)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at positions."""
        at = at.astype(np.int64)
        out = np.zeros(len(at), np.int64)
        for zeros, before in zip(self.zeros, self.before):
            at0 = before[at].astype(np.int64)
            one = before[at + 1] == at0
            out = out * 2 + one
            at = np.where(one, zeros + at - at0, at0)
        return out


class FMIndex:
    """Counts and finds phrases in a sequence of positive integers."""

    def __init__(self, seq: np.ndarray, sample: int = 8):
        seq = np.concatenate((np.asarray(seq, np.int64), [0]))
        sa = suffix_array(seq)
        self.n = len(seq)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq))))
        self.bwt = WaveletMatrix(seq[sa - 1])
        marked = sa % sample == 0
        self.marked = marked
        self.mark_rank = np.concatenate(([0], np.cumsum(marked)))
        self.positions = sa[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each phrase (a row, filled up at its end) the range of suffixes that begin with it, by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        symbols = len(self.first) - 1
        for j in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > j) & (low < high))
            if not len(live):
                continue
            s = phrases[live, j]
            known = s < symbols
            s = np.where(known, s, 0)
            start = self.first[s]
            low[live] = np.where(known, start + self.bwt.rank(s, low[live]), 0)
            high[live] = np.where(known, start + self.bwt.rank(s, high[live]), 0)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes in rows: step back until one that is sampled."""
        out = np.zeros(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        live, rows = np.arange(len(rows)), rows.astype(np.int64)
        while len(live):
            done = self.marked[rows[live]]
            end = live[done]
            out[end] = self.positions[self.mark_rank[rows[end]]] + steps[end]
            live = live[~done]
            s = self.bwt.access(rows[live])
            rows[live] = self.first[s] + self.bwt.rank(s, rows[live])
            steps[live] += 1
        return out
