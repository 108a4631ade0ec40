"""A minimal perfect hash over 128-bit keys, built and probed with whole arrays.

Each level throws the keys that are left at twice as many bits. A key alone on its bit stays there;
the others go to the next level. A key's slot is the number of set bits before its own.
"""

from __future__ import annotations

import numpy as np

_BITS_PER_KEY = 2
_MOST_LEVELS = 200
_POP = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def _mixed(lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """Other well-mixed 64 bits for every level (a multiply-and-shift finaliser)."""
    with np.errstate(over="ignore"):
        x = lo + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = ((x ^ hi) ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bits in bytes, the lowest first
        self.before, start = [], 0
        for packed in levels:
            counted = np.cumsum(_POP[packed], dtype=np.int64)
            self.before.append(start + np.concatenate([[0], counted[:-1]]).astype(np.int64))
            start += int(counted[-1])
        self.size = start

    @classmethod
    def build(cls, lo: np.ndarray, hi: np.ndarray) -> PerfectHash:
        """``lo`` and ``hi`` (uint64) hold the halves of keys that all differ."""
        levels = []
        while lo.size:
            if len(levels) == _MOST_LEVELS:
                raise ValueError("equal keys")
            bits = -(-max(64, _BITS_PER_KEY * lo.size) // 8) * 8
            at = (_mixed(lo, hi, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = ~alone[at]
            lo, hi = lo[left], hi[left]
        return cls(levels)

    def slots(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """A slot for each key: its own for a key of the set, any or -1 for a foreign one."""
        found = np.full(lo.size, -1, np.int64)
        left = np.arange(lo.size)
        for level, (packed, before) in enumerate(zip(self.levels, self.before, strict=True)):
            if not left.size:
                break
            at = (_mixed(lo[left], hi[left], level) % np.uint64(packed.size * 8)).astype(np.int64)
            byte, bit = packed[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            lower = byte & ((np.uint8(1) << bit) - np.uint8(1))
            found[left[hit]] = (before[at >> 3] + _POP[lower])[hit]
            left = left[~hit]
        return found
