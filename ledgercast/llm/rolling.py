"""Hashes of all substrings of a byte array at once.

H is the running sum of T[byte] x M^position modulo 2^64, T a fixed random table. The hash of a
stretch is (H[end] - H[start]) / M^start, the same wherever the stretch stands, then mixed.
"""

from __future__ import annotations

import numpy as np

MULTIPLIER = 0x5851F42D4C957F2D
TABLE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
WHITE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])

_powers = {MULTIPLIER: np.ones(1, dtype=np.uint64), pow(MULTIPLIER, -1, 1 << 64): np.ones(1, dtype=np.uint64)}


def powers(base: int, count: int) -> np.ndarray:
    known = _powers[base]
    while len(known) < count:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
        _powers[base] = known
    return known[:count]


def running(data: np.ndarray) -> np.ndarray:
    """H, one longer than the bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(TABLE[data] * powers(MULTIPLIER, len(data)), out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def stretches(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end)."""
    inverse = powers(pow(MULTIPLIER, -1, 1 << 64), len(sums))
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def all_of_length(sums: np.ndarray, length: int) -> np.ndarray:
    """Hash of the stretch of this length at every start."""
    count = max(0, len(sums) - length)
    inverse = powers(pow(MULTIPLIER, -1, 1 << 64), len(sums))
    return mixed((sums[length : length + count] - sums[:count]) * inverse[:count])


def sliding(best: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    if len(values) < width:
        return values[:0]
    covered = 1
    while 2 * covered <= width:
        values = best(values[:-covered], values[covered:])
        covered *= 2
    rest = width - covered
    return best(values[:-rest], values[rest:]) if rest else values
