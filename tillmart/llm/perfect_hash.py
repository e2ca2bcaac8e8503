"""Minimal perfect hashing of distinct 64-bit keys in buckets.

A bucket's n keys get the slots 0 .. n-1 by cascading bit arrays: on each
level the keys are hashed to twice as many bits as there are keys left, those
alone on their bit stay there, the others go on to the next level.  A key's
slot is the number of set bits before its own.  The function takes some four
bits a key and knows no keys: a key that was not hashed may get any slot, so
the keys are kept in slot order beside it and compared.
"""

from __future__ import annotations

import numpy as np

WORD = 64
# Buckets a key may fall into at first; a coarser count that divides it merges them.
FINE = 4096
LAST_LEVEL = 200


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each key, another one for every level."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fine_bucket(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, LAST_LEVEL + 1) % np.uint64(FINE)).astype(np.int32)


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(words of each level, the bits as 64-bit words) for distinct keys."""
    sizes, words = [], []
    left = keys.astype(np.uint64)
    while len(left):
        size = -(-2 * len(left) // WORD)
        at = (mixed(left, len(sizes)) % np.uint64(size * WORD)).astype(np.int64)
        alone = np.bincount(at, minlength=size * WORD) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~alone[at]]
        if len(sizes) > LAST_LEVEL:
            raise ValueError("the keys are not distinct")
    return sizes, np.concatenate(words) if words else np.zeros(0, np.uint64)


class PerfectHash:
    """The functions of several buckets, asked for many keys at once."""

    def __init__(self, functions: list[tuple[list[int], np.ndarray, int]]):
        """``functions``: (words of each level, bits, number of keys) of bucket 0, 1, ..."""
        levels = max([1, *(len(sizes) for sizes, _, _ in functions)])
        self.buckets = len(functions)
        self.size = np.zeros((self.buckets, levels), dtype=np.int64)
        for b, (sizes, _, _) in enumerate(functions):
            self.size[b, : len(sizes)] = sizes
        ends = np.cumsum(self.size.reshape(-1)).reshape(self.size.shape)
        self.start = ends - self.size
        self.words = np.concatenate([np.zeros(0, np.uint64), *(bits for _, bits, _ in functions)]).astype(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.keys = sum(n for _, _, n in functions)

    def slots(self, keys: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The slot of each key counted over all buckets, -1 if no level holds it."""
        out = np.full(len(keys), -1, dtype=np.int64)
        keys, asked = keys.astype(np.uint64), np.arange(len(keys))
        for level in range(self.size.shape[1]):
            size = self.size[bucket[asked], level]
            asked, size = asked[size > 0], size[size > 0]
            if not len(asked):
                break
            at = (mixed(keys[asked], level) % (size * WORD).astype(np.uint64)).astype(np.int64)
            word = self.start[bucket[asked], level] + at // WORD
            bit = (at % WORD).astype(np.uint64)
            held = self.words[word] >> bit & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[asked[held]] = (self.before[word] + np.bitwise_count(below))[held]
            asked = asked[~held]
        return out
