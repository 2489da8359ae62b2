"""Minimal perfect hash of 128-bit keys in numpy: levels of bit arrays with ranks.

A key that no other key of its level collides with sets its bit there; the
others go to the next, smaller level. A key's slot is the number of set bits
before its own over all levels, so n keys get the slots 0..n-1.
"""

from __future__ import annotations

import numpy as np

from pipewright.llm.common import mix

GAMMA = 2  # bits of a level for each key that enters it


def _positions(lo: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mix(lo + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))) % np.uint64(bits)).astype(np.int64)


class Mphf:
    def __init__(self, levels: list[tuple[int, np.ndarray, np.ndarray, int]]):
        self.levels = levels  # (bits, packed words, set bits before each word, slots before the level)

    @classmethod
    def build(cls, lo: np.ndarray) -> Mphf:
        """``lo``: distinct uint64 values (any well-mixed 64 bits of the keys)."""
        levels, rest, base, level = [], lo, 0, 0
        while len(rest):
            bits = max(64, -(-GAMMA * len(rest) // 64) * 64)
            pos = _positions(rest, level, bits)
            alone = np.bincount(pos, minlength=bits)[pos] == 1
            flags = np.zeros(bits, np.uint8)
            flags[pos[alone]] = 1
            words = np.packbits(flags, bitorder="little").view(np.uint64)
            ranks = np.r_[0, np.cumsum(np.bitwise_count(words))[:-1]].astype(np.int64)
            levels.append((bits, words, ranks, base))
            base += int(alone.sum())
            rest, level = rest[~alone], level + 1
        return cls(levels)

    def slots(self, lo: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 if no level holds it (other foreign keys get any slot: check the fingerprint)."""
        out = np.full(len(lo), -1, np.int64)
        left = np.arange(len(lo))
        for level, (bits, words, ranks, base) in enumerate(self.levels):
            if not len(left):
                break
            pos = _positions(lo[left], level, bits)
            w, b = pos >> 6, (pos & 63).astype(np.uint64)
            at = (words[w] >> b) & np.uint64(1) == 1
            below = words[w] & ((np.uint64(1) << b) - np.uint64(1))
            out[left[at]] = base + ranks[w[at]] + np.bitwise_count(below[at])
            left = left[~at]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.levels)] + [x for bits, _, _, base in self.levels for x in (bits, base)], np.int64)
        return head.tobytes() + b"".join(w.tobytes() + r.tobytes() for _, w, r, _ in self.levels)

    @classmethod
    def load(cls, blob: bytes) -> Mphf:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        head = np.frombuffer(blob, np.int64, 2 * n, 8).reshape(n, 2)
        levels, at = [], 8 + 16 * n
        for bits, base in head.tolist():
            k = bits // 64
            words = np.frombuffer(blob, np.uint64, k, at)
            ranks = np.frombuffer(blob, np.int64, k, at + 8 * k)
            levels.append((bits, words, ranks, base))
            at += 16 * k
        return cls(levels)
