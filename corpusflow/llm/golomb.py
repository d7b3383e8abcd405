"""Golomb codes with a power-of-two parameter for sorted 64-bit numbers, in numpy.

A block is ``n, b, first`` and two bit streams: the quotients of the gaps in unary, and
their low ``b`` bits. ``b`` follows the mean gap, so a random sorted set costs about
``log2(gap) + 1.5`` bits a member.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IBQI")  # n, b, first, bytes of the unary stream


def encode(values: np.ndarray) -> bytes:
    """``values``: ascending unsigned 64-bit numbers (repeats allowed)."""
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0, 0)
    values = values.astype(np.uint64, copy=False)
    gaps = np.diff(values)
    mean = int(values[-1] - values[0]) // max(n - 1, 1)
    b = max(mean.bit_length() - 1, 0)
    quotients = (gaps >> np.uint64(b)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n > 1 else 0, np.uint8)
    unary[ends] = 1
    head = np.packbits(unary).tobytes()
    low = b""
    if b and n > 1:
        bits = np.unpackbits(gaps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :b]
        low = np.packbits(bits.ravel()).tobytes()
    return _HEAD.pack(n, b, int(values[0]), len(head)) + head + low


def decode(block: bytes) -> np.ndarray:
    n, b, first, size = _HEAD.unpack_from(block)
    if n == 0:
        return np.zeros(0, np.uint64)
    at = _HEAD.size
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(block, np.uint8, size, at)))[: n - 1]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(b)
    if b and n > 1:
        bits = np.unpackbits(np.frombuffer(block, np.uint8, offset=at + size), count=(n - 1) * b).reshape(n - 1, b)
        whole = np.zeros((n - 1, 64), np.uint8)
        whole[:, :b] = bits
        gaps = gaps + np.packbits(whole, axis=1, bitorder="little").view(np.uint64).ravel()
    out = np.empty(n, np.uint64)
    out[0] = first
    out[1:] = np.uint64(first) + np.cumsum(gaps, dtype=np.uint64)
    return out
