"""Anchors: a few positions of a text that every long enough window shares.

Every window of ``span`` bytes picks one anchor, the position inside it whose
``GRAM``-byte string has the least hash (leftmost on ties).  Equal windows
pick equal strings at equal offsets, so what may repeat meets by the anchor's
string; consecutive windows mostly pick the same anchor, so anchors are about
2 / span of the bytes.
"""

from __future__ import annotations

import numpy as np

GRAM = 32
_rng = np.random.default_rng(23)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, b & (1 << 64) - 1, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """64-bit hashes of any substrings of one text, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, inverse = _power_tables(n + 1)
        self.inverse = inverse
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[data] * power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, size: int) -> np.ndarray:
        m = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:m]) * self.inverse[:m])


def anchors(data: np.ndarray, span: int):
    """(hashes, anchor positions, their grams' hashes, first and last window
    start that picks each)."""
    hashes = Hashes(data)
    grams = hashes.grams(GRAM)
    width = span - GRAM + 1                  # gram positions per window
    count = len(data) - span + 1             # windows
    bits = max(8, int(len(grams)).bit_length())
    key = (grams >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(grams), dtype=np.uint64)
    blocks = -(-len(key) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(key)] = key
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[width - 1:width - 1 + count])
    chosen = (least & np.uint64((1 << bits) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    last = np.append(first[1:], count) - 1
    at = chosen[first]
    return hashes, at, grams[at], first, last
