"""Polynomial hashes of byte strings on arrays, modulo 2**64."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(0x5EED)
#: An odd random number for each byte value, the base and its inverse.
BYTE = _rng.integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0..n-1 of the base (or of its inverse); at most twice as many are kept."""
    have = _powers[inverse]
    if len(have) < n:
        step = np.full(max(n, 1 << 12), _INVERSE if inverse else BASE, np.uint64)
        step[0] = 1
        have = _powers[inverse] = np.multiply.accumulate(step)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte times power: one more entry than ``data``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(len(data)), out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]``, the same wherever the bytes stand."""
    return (sums[end] - sums[start]) * powers(len(sums), inverse=True)[start]
