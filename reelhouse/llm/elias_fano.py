"""Elias-Fano coding of monotone sequences in arrays that can be memory-mapped."""

from __future__ import annotations

import numpy as np

_ONE, _63 = np.uint64(1), np.uint64(63)


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th (from 0) set bit of each 64-bit word."""
    at = np.zeros(len(word), dtype=np.int64)
    word, k = word.copy(), k.astype(np.int64).copy()
    for half in (32, 16, 8, 4, 2, 1):
        n = np.bitwise_count(word & np.uint64((1 << half) - 1)).astype(np.int64)
        up = k >= n
        k -= np.where(up, n, 0)
        at += np.where(up, half, 0)
        word = np.where(up, word >> np.uint64(half), word)
    return at


class EliasFano:
    """n sorted values below ``universe``: low bits packed, high bits in unary.

    ``high`` has a one for each value and a zero for each step of the high
    part; running counts of ones a word make selection a search in one array.
    """

    FIELDS = ("low", "high", "ones")

    def __init__(self, n: int, shift: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.shift, self.low, self.high, self.ones = n, shift, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        shift = max(0, (universe // max(1, n)).bit_length() - 1)
        top = int(values[-1] >> np.uint64(shift)) + 1 if n else 1
        at = (values >> np.uint64(shift)).astype(np.int64) + np.arange(n)
        high = np.zeros((n + top + 64) // 64 + 1, dtype=np.uint64)
        np.bitwise_or.at(high, at >> 6, _ONE << (at.astype(np.uint64) & _63))
        low = np.zeros(n * shift // 64 + 2, dtype=np.uint64)
        if shift:
            part = values & np.uint64((1 << shift) - 1)
            bit = np.arange(n, dtype=np.uint64) * np.uint64(shift)
            word, off = (bit >> np.uint64(6)).astype(np.int64), bit & _63
            np.bitwise_or.at(low, word, part << off)
            over = off + np.uint64(shift) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - off[over]))
        return cls(n, shift, low, high, np.cumsum(np.bitwise_count(high).astype(np.int64)))

    def _select(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, k, side="right")
        before = np.where(word > 0, self.ones[word - 1], 0)
        return (word << 6) + _select_in_word(self.high[word], k - before)

    def _select_zero(self, k: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_zeros"):
            self._zeros = np.arange(1, len(self.high) + 1) * 64 - self.ones
        word = np.minimum(np.searchsorted(self._zeros, k, side="right"), len(self.high) - 1)
        before = np.where(word > 0, self._zeros[word - 1], 0)
        return (word << 6) + _select_in_word(~self.high[word], k - before)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the positions ``i``."""
        high = (self._select(i) - i).astype(np.uint64) << np.uint64(self.shift)
        if not self.shift:
            return high
        bit = i.astype(np.uint64) * np.uint64(self.shift)
        word, off = (bit >> np.uint64(6)).astype(np.int64), bit & _63
        out = self.low[word] >> off
        more = off + np.uint64(self.shift) > np.uint64(64)
        out[more] |= self.low[word[more] + 1] << (np.uint64(64) - off[more])
        return high | (out & np.uint64((1 << self.shift) - 1))

    def successor(self, values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Per value, the first position in [start, stop) not below it (or stop)."""
        lo, hi = start.astype(np.int64).copy(), stop.astype(np.int64).copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.access(mid) < values[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, -1 where it is none of the sequence."""
        if not self.n:
            return np.full(len(values), -1, dtype=np.int64)
        top = (values >> np.uint64(self.shift)).astype(np.int64)
        last = self._select(np.array([self.n - 1]))[0] - (self.n - 1)  # greatest high part
        known = np.minimum(top, last)
        start = np.where(known > 0, self._select_zero(np.maximum(known - 1, 0)) - known + 1, 0)
        stop = np.minimum(self._select_zero(known) - known, self.n)
        at = self.successor(values, start, stop)
        safe = np.minimum(at, self.n - 1)
        return np.where((at < stop) & (top <= last) & (self.access(safe) == values), safe, -1)
