"""A minimal perfect hash over 64-bit keys, built and probed with numpy.

Keys are placed level by level: at each level every remaining key points to
one bit of a bit array of about ``GAMMA`` bits a key, and the keys that are
alone at their bit stay there. The slot of a key is the number of set bits
before its own, over all levels. Keys that meet at every level (equal 64-bit
keys) are kept in a short sorted list behind the slots. Slots of n keys are
exactly 0..n-1. A key that is not in the set gets -1 or some slot, so callers
keep a fingerprint beside each slot if strangers may ask.
"""

from __future__ import annotations

import struct

import numpy as np

from gapwise.llm.arrowtext import mix

GAMMA = 1.6
MAX_LEVELS = 40


def _place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    h = mix(keys + np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1)))
    return ((h >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)


class MinimalPerfectHash:
    def __init__(self, sizes: list[int], words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, rest
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.starts = np.concatenate([[0], np.cumsum([s // 64 for s in sizes])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "MinimalPerfectHash":
        left, sizes, words = np.asarray(keys, np.uint64), [], []
        while len(left) and len(sizes) < MAX_LEVELS:
            bits = -(-max(64, int(len(left) * GAMMA)) // 64) * 64
            at = _place(left, len(sizes), bits)
            alone = np.bincount(at, minlength=bits) == 1
            sizes.append(bits)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"), np.sort(left))

    def __len__(self) -> int:
        return int(self.before[-1]) + len(self.rest)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that are not in the set."""
        keys = np.asarray(keys, np.uint64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.sizes):
            if not len(left):
                return out
            at = _place(keys[left], level, bits)
            word = self.starts[level] + (at >> 6)
            bit = (at & 63).astype(np.uint64)
            value = self.words[word]
            hit = (value >> bit) & np.uint64(1) == 1
            under = value[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[word[hit]] + np.bitwise_count(under).astype(np.int64)
            left = left[~hit]
        if len(left) and len(self.rest):
            at = np.searchsorted(self.rest, keys[left])
            ok = (at < len(self.rest)) & (self.rest[np.minimum(at, len(self.rest) - 1)] == keys[left])
            out[left[ok]] = self.before[-1] + at[ok]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<III", len(self.sizes), len(self.words), len(self.rest))
        return b"".join([head, np.array(self.sizes, "<u8").tobytes(),
                         self.words.astype("<u8").tobytes(), self.rest.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> "MinimalPerfectHash":
        levels, words, rest = struct.unpack_from("<III", data)
        a = np.frombuffer(data, "<u8", offset=12) if len(data) % 8 == 4 else None
        if a is None or len(a) != levels + words + rest:
            raise ValueError("not a minimal perfect hash")
        return cls([int(x) for x in a[:levels]], a[levels:levels + words], a[levels + words:])
