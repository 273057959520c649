"""Hashed characters and words of many texts at once, as numpy arrays.

A batch of texts becomes one array of code points, with a space on either side
of each text, so nothing reaches from one text into the next and the features
of a text do not depend on its batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: Odd multipliers of the hashes (fixed values).
MIX, MIX_2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
WIDE, WIDE_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: No letter, digit or space lies above (fixed value).
ASSIGNED = 0x34000


@lru_cache
def class_of(test: Callable[[str], bool]) -> np.ndarray:
    """Truth of a character test for every code point."""
    found = np.zeros(0x110000, bool)
    found[:ASSIGNED] = np.fromiter((test(chr(i)) for i in range(ASSIGNED)), bool, ASSIGNED)
    return found


@dataclass
class Batch:
    """Code points of some texts; text ``i`` owns ``starts[i]`` to ``starts[i + 1]``."""

    codes: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: Iterable[str]) -> Batch:
        padded = [f" {t} " for t in texts]
        codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
        return cls(codes, np.concatenate([[0], np.cumsum([len(t) for t in padded], dtype=np.int64)]))

    def within(self, n: int) -> np.ndarray:
        """Positions from which ``n`` code points belong to one text."""
        whole = np.ones(max(0, len(self.codes) - n + 1), bool)
        for i in range(1, n):
            whole[self.starts[1:-1] - i] = False
        return np.flatnonzero(whole)

    def totals(self, at: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        """Sum of ``values`` (1 each if none) over each text's positions ``at``, which rise."""
        edges = np.searchsorted(at, self.starts)
        if values is None:
            return np.diff(edges)
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return sums[edges[1:]] - sums[edges[:-1]]


def scramble(h: np.ndarray, bits: int) -> np.ndarray:
    h = h ^ (h >> np.uint32(15))
    h *= MIX_2
    return h >> np.uint32(32 - bits)


def grams(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash of the ``n`` code points from each position on; ``n - 1`` fewer than codes."""
    size = max(0, len(codes) - n + 1)
    h = np.full(size, n, np.uint32)
    for i in range(n):
        h *= MIX
        h += codes[i : i + size]
    h *= MIX
    return scramble(h, bits)


@dataclass
class Words:
    """Runs of characters of one class: first position, length and 64-bit hash."""

    at: np.ndarray
    size: np.ndarray
    hash: np.ndarray


def words(codes: np.ndarray, inside: np.ndarray) -> Words:
    edge = np.flatnonzero(np.diff(inside.view(np.int8)))  # every text has a space on either side
    at, end = edge[::2] + 1, edge[1::2] + 1
    size = end - at
    if not len(at):
        return Words(at, size, np.zeros(0, np.uint64))
    places = np.flatnonzero(inside)
    h = codes[places].astype(np.uint64)
    h += (places - np.repeat(at, size)).astype(np.uint64) * WIDE_2
    h *= WIDE
    h ^= h >> np.uint64(29)
    h *= WIDE_2
    h ^= h >> np.uint64(32)
    return Words(at, size, np.add.reduceat(h, np.cumsum(size) - size))


def fold(h: np.ndarray, bits: int) -> np.ndarray:
    """A 64-bit hash as a bucket number."""
    return ((h * WIDE) >> np.uint64(64 - bits)).astype(np.int64)
