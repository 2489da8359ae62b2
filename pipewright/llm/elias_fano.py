"""Elias-Fano coding of monotone integer sequences, with vectorised access and successor search."""

from __future__ import annotations

import numpy as np


class EliasFano:
    """Non-decreasing values below ``universe``: packed low bits, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self._at: np.ndarray | None = None

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, int(universe // max(1, n)).bit_length() - 1)
        v = values.astype(np.uint64)
        low = np.zeros(0, np.uint8)
        if bits and n:
            flags = ((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            low = np.packbits(flags.ravel(), bitorder="little")
            low = np.r_[low, np.zeros(16 - len(low) % 8, np.uint8)]  # whole 64-bit words, and one to read beyond
        up = (v >> np.uint64(bits)).astype(np.int64)
        unary = np.zeros(n + (int(up[-1]) if n else 0) + 1, np.uint8)
        unary[up + np.arange(n)] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little"))

    def _ones(self) -> np.ndarray:
        """Positions of the set bits (one for each value)."""
        if self._at is None:
            self._at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return self._at

    def get(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        out = ((self._ones()[i] - i) << self.low_bits).astype(np.int64)
        if self.low_bits:
            first = i * self.low_bits
            word, shift = self.low.view(np.uint64), (first & 63).astype(np.uint64)
            at = first >> 6
            # the bits that stand in the next word; shifted twice, as a shift by 64 is none
            low = (word[at] >> shift) | ((word[at + 1] << (np.uint64(63) - shift)) << np.uint64(1))
            out |= (low & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)
        return out

    def successor(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each x the first index in [lo, hi) whose value is at least x (hi if none)."""
        lo, hi = np.asarray(lo, np.int64).copy(), np.asarray(hi, np.int64).copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self.get(mid) < x[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        return lo

    def dump(self) -> tuple[np.ndarray, list[np.ndarray]]:
        return np.array([self.n, self.low_bits, len(self.low), len(self.high)], np.int64), [self.low, self.high]

    @classmethod
    def load(cls, head: np.ndarray, data: np.ndarray) -> EliasFano:
        n, bits, a, b = head.tolist()
        return cls(n, bits, data[:a], data[a:a + b])
