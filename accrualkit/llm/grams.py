"""Hashed byte n-grams of words, and a bounded cache of per-word rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def char_grams(words: list[str], low: int, high: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of ``2**bits``, index of its word) of every ``low`` to ``high`` byte gram of ``<word>``."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer("".join(f"<{w}>\n" for w in words).encode(), np.uint8)
    breaks = raw == 10
    owner = np.cumsum(breaks) - breaks
    buckets, owners = [], []
    code, crossed = raw.astype(np.uint32), breaks.copy()
    for n in range(1, high + 1):
        if n > 1:
            code = code[:-1] * np.uint32(0x01000193) ^ raw[n - 1 :].astype(np.uint32)
            crossed = crossed[:-1] | breaks[n - 1 :]
        if n >= low:
            inside = np.flatnonzero(~crossed)
            mixed = (code[inside] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            buckets.append((mixed >> np.uint32(32 - bits)).astype(np.int64))
            owners.append(owner[inside])
    return np.concatenate(buckets), np.concatenate(owners)


class WordRows:
    """Rows of numbers for words, computed once while they stay in a cache of ``capacity`` words."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, capacity: int):
        self.compute, self.capacity = compute, capacity
        self.row: dict[str, int] = {}
        self.table = np.empty((capacity, width), np.float32)

    def indices(self, words: list[str]) -> np.ndarray:
        """Where the rows of ``words`` (at most ``capacity``) are in ``table``, until the next call."""
        row = self.row
        new = [w for w in dict.fromkeys(words) if w not in row]
        if len(row) + len(new) > self.capacity:
            row.clear()
            new = list(dict.fromkeys(words))
        if new:
            at = len(row)
            self.table[at : at + len(new)] = self.compute(new)
            row.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(row.__getitem__, words), np.int64, len(words))
