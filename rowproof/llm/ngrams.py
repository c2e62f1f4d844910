"""Hashed words and character n-grams of a text, computed over whole arrays of code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters hashed at once; longer texts are taken slice by slice, none is cut short.
SLICE_CHARS = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
_SPACES = np.zeros(128, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def slices(text: str, overlap: int) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of each slice with ``overlap`` more behind it, and the slice's own length."""
    for first in range(0, len(text), SLICE_CHARS):
        part = text[first:first + SLICE_CHARS + overlap]
        yield code_points(part), min(SLICE_CHARS, len(text) - first)


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Multiplicative hashing to ``2**bits`` buckets."""
    return ((hashes ^ (hashes >> np.uint64(29))) * _MIX >> np.uint64(64 - bits)).astype(np.int64)


def gram_hashes(points: np.ndarray, n: int, own: int) -> np.ndarray:
    """Hashes of the n-grams that begin in the first ``own`` places."""
    many = min(own, len(points) - n + 1)
    if many <= 0:
        return np.zeros(0, np.uint64)
    wide = points.astype(np.uint64)
    hashes = np.full(many, n, np.uint64)
    for j in range(n):
        hashes = (hashes ^ wide[j:j + many]) * _MIX
        hashes ^= hashes >> np.uint64(31)
    return hashes


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class WordHasher:
    """Hashes of blank-separated words by differences of one running polynomial."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        if len(points) > len(self.up):
            n = 1 << int(len(points) - 1).bit_length()
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        blank = (points < 128) & _SPACES[np.minimum(points, 127)]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
        first, past = edges[::2], edges[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.up[:len(points)])))
        return (sums[past] - sums[first]) * self.down[first]
