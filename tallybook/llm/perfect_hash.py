"""A minimal perfect hash over 64-bit keys, in NumPy.

Levels of bit arrays: a key is placed on the first level where no other
remaining key shares its bit; the rank of its bit among all set bits is its
slot. About 3.7 bits a key with the ranks. Build and lookup are vectorised
over all keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

_MUL = np.uint64(0xFF51AFD7ED558CCD)
_ALL = 0xFFFFFFFFFFFFFFFF


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * _MUL
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


@dataclass
class PerfectHash:
    """``sizes``: bits of each level; ``words``: all levels' bits, 64 to a word;
    ``ranks``: set bits before each word."""
    sizes: np.ndarray
    words: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        """Over distinct keys."""
        sizes, bits, left = [], [], keys.astype(np.uint64)
        while len(left):
            if len(sizes) > 200:
                raise ValueError("the keys are not distinct")
            size = -(-max(64, int(gamma * len(left))) // 64) * 64
            at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        flat = np.concatenate(bits) if bits else np.zeros(64, bool)
        words = np.packbits(flat, bitorder="little").view(np.uint64)
        count = np.bitwise_count(words).astype(np.int64)
        return cls(np.array(sizes or [64], np.int64), words, np.concatenate([[0], np.cumsum(count)[:-1]]))

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, 0 to n - 1. For a key that wasn't built in: any
        slot, or 0; compare what is kept there."""
        keys = keys.astype(np.uint64)
        out, left, base = np.zeros(len(keys), np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = (mix(keys[left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = self.ranks[at[hit] >> 6] + below[hit]
            left = left[~hit]
            base += size
        return out

    def finder(self) -> Callable[[int], int]:
        """``lookup`` of one key at a time, in plain integers."""
        sizes, words, ranks = self.sizes.tolist(), self.words.tolist(), self.ranks.tolist()
        seeds = [(k * 0x9E3779B97F4A7C15 + 0x1234567) & _ALL for k in range(len(sizes))]

        def find(key: int) -> int:
            base = 0
            for size, seed in zip(sizes, seeds):
                x = key ^ seed
                x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & _ALL
                x = ((x ^ (x >> 29)) * 0xC4CEB9FE1A85EC53) & _ALL
                at = (x ^ (x >> 32)) % size + base
                word = words[at >> 6]
                if word >> (at & 63) & 1:
                    return ranks[at >> 6] + (word & ((1 << (at & 63)) - 1)).bit_count()
                base += size
            return 0

        return find

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.words)], np.int64)
        return b"".join(a.tobytes() for a in (head, self.sizes, self.words, self.ranks))

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        a, b = np.frombuffer(data, np.int64, 2).tolist()
        return cls(np.frombuffer(data, np.int64, a, 16), np.frombuffer(data, np.uint64, b, 16 + 8 * a),
                   np.frombuffer(data, np.int64, b, 16 + 8 * (a + b)))
