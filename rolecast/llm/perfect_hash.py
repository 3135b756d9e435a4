"""Minimal perfect hash of a set of 64-bit key hashes, as arrays.

Level by level, each remaining key sets the bit of its position unless another key wants
the same; those keys go on to the next level. A key's slot is the number of bits before its
own. A lookup reads one bit per level, few on average whatever the number of keys."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from rolecast.llm.texts import mix

#: Bits of a level for each key that reaches it.
GAMMA = 2.0
_STEP = 0x9E3779B97F4A7C15


def _positions(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64((level + 1) * _STEP % 2**64)) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    sizes: list[int]  # bits of each level
    bits: np.ndarray  # all levels, packed
    ranks: np.ndarray  # set bits before each 64-bit word

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """`hashes` must be distinct."""
        sizes, levels, rest = [], [], hashes
        while len(rest):
            size = -(-max(64, int(GAMMA * len(rest))) // 64) * 64
            places = _positions(rest, len(sizes), size)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            rest = rest[~alone[places]]
        flat = np.concatenate(levels) if levels else np.zeros(0, bool)
        bits = np.packbits(flat, bitorder="little").view("<u8")
        return cls(sizes, bits, _ranks(bits))

    @classmethod
    def load(cls, sizes: list[int], bits: np.ndarray) -> PerfectHash:
        return cls(sizes, bits, _ranks(bits))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key of the set; another key gets some slot or -1."""
        found = np.full(len(hashes), -1, np.int64)
        open_, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            places = base + _positions(hashes[open_], level, size)
            word, bit = self.bits[places >> 6], (places & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[open_[hit]] = (self.ranks[places >> 6] + below)[hit]
            open_, base = open_[~hit], base + size
        return found


def _ranks(bits: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])[:-1]
