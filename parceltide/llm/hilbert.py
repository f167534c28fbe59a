"""Positions of points on a Hilbert curve (Skilling's transform), for whole batches of points."""

from __future__ import annotations

import numpy as np


def hilbert_bits(levels: np.ndarray, bits: int) -> np.ndarray:
    """Curve positions of the rows of ``levels`` (whole numbers below 2 ** bits), as rows of bits, most significant first.

    Rows of neighbouring positions differ by one in one coordinate.
    """
    n, dims = levels.shape
    x = levels.astype(np.uint32).T.copy()  # one row per coordinate
    if not dims:
        return np.zeros((n, 0), dtype=bool)
    step = 1 << (bits - 1)
    while step > 1:
        rest = np.uint32(step - 1)
        for axis in range(dims):
            set_here = (x[axis] & step) != 0
            swap = np.where(set_here, 0, (x[0] ^ x[axis]) & rest).astype(np.uint32)
            x[0] ^= np.where(set_here, rest, swap).astype(np.uint32)
            x[axis] ^= swap
        step >>= 1
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(n, dtype=np.uint32)
    step = 1 << (bits - 1)
    while step > 1:
        turn ^= np.where((x[-1] & step) != 0, step - 1, 0).astype(np.uint32)
        step >>= 1
    x ^= turn
    planes = [(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)]
    return np.concatenate(planes).T.astype(bool)


def hilbert_keys(levels: np.ndarray, bits: int) -> list[bytes]:
    """Curve positions as byte strings that sort like the positions."""
    packed = np.packbits(hilbert_bits(levels, bits), axis=1)
    return [row.tobytes() for row in packed]
