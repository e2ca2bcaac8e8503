"""Bounded per-worker memory of values that depend on a word alone."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np

# Bytes that an entry of a dictionary takes beside its key and its value.
ENTRY_BYTES = 100
# Bytes of one generation of a memory.
MEMORY_BYTES = 64_000_000


def weight(key, value) -> int:
    return sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES


class Memo(dict):
    """``compute(key)`` remembered in two generations of up to ``most`` keys
    and ``most_bytes`` bytes: when the young one is full it becomes the old one
    and the old one is forgotten; a key found in the old one moves on to the
    young one.  Rare keys go, frequent ones stay, and forgetting changes no
    result.  An entry of more than a hundredth of the bytes is not kept."""

    def __init__(self, compute: Callable, most: int = 100_000, most_bytes: int = MEMORY_BYTES):
        super().__init__()
        self.compute, self.most, self.most_bytes = compute, most, most_bytes
        self.old: dict = {}
        self.bytes = 0

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.compute(key)
        size = weight(key, value)
        if size * 100 > self.most_bytes:
            return value
        if len(self) >= self.most or self.bytes + size > self.most_bytes:
            self.old = dict(self)
            self.clear()
            self.bytes = 0
        self.bytes += size
        self[key] = value
        return value


class WordRows(dict):
    """``compute(words)``, a row of ``width`` numbers for each word, remembered
    as rows of one matrix, so that a text's sum over its words is one indexed
    sum and the new words of a text are computed together.  Emptied before a
    text when the words known are more than ``most`` or, with their rows, more
    than ``most_bytes``; grows within one text."""

    def __init__(self, compute: Callable, width: int, most: int = 500_000, most_bytes: int = 2 * MEMORY_BYTES):
        super().__init__()
        self.compute, self.most, self.most_bytes = compute, most, most_bytes
        self.rows = np.zeros((1024, width))
        self.bytes = 0

    def sum(self, words: list) -> np.ndarray:
        if len(self) > self.most or self.bytes > self.most_bytes:
            self.clear()
            self.bytes = 0
            self.rows = self.rows[:1024].copy()
        new = [w for w in set(words) if w not in self]
        if new:
            start = len(self)
            self.update(zip(new, range(start, start + len(new))))
            self.bytes += sum(map(sys.getsizeof, new)) + len(new) * (ENTRY_BYTES + self.rows.itemsize * self.rows.shape[1])
            while len(self) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[start : len(self)] = self.compute(new)
        codes = [self[w] for w in words]
        return self.rows[codes].sum(axis=0)
