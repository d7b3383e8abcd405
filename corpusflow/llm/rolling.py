"""Polynomial hashes of byte spans modulo 2^64 in numpy, from sums over prefixes."""

from __future__ import annotations

import functools

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LEAST = 1 << 21


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    powers = np.full(n + 1, _BASE, np.uint64)
    inverse = np.full(n + 1, _INVERSE, np.uint64)
    powers[0] = inverse[0] = 1
    return np.cumprod(powers, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


@functools.lru_cache(4)
def _values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A hash of ``data[start:end]`` for each span (equal bytes, equal hash)."""
    powers, inverse = _powers(1 << max(_LEAST, len(data)).bit_length())
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_values(seed)[data] * powers[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * inverse[starts])
