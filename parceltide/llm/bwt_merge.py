"""Burrows-Wheeler transforms of many short strings, and their merge.

Strings are rows of one symbol matrix, each closed by the smallest symbol 0. A
shard's transform comes from sorting its rotations once. Transforms are merged by
interleave refinement (Holt and McMillan, 2014): starting from one shard after
the other, each pass moves every position to where its preceding symbol sends
it, so that after h passes the interleave is sorted by h symbols. Positions that
part in pass h have a common prefix of h - 1 symbols (Egidi and Manzini, 2017),
and what is still together is a repeated interval. No suffix is sorted again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Transform:
    """``symbols``: the transform; ``rotations``: the flat (row, column) index of every sorted rotation."""

    symbols: np.ndarray
    rotations: np.ndarray


def transform(rows: np.ndarray) -> Transform:
    """Transform of the rows, whose last column must be 0, by prefix doubling over rotations."""
    count, width = rows.shape
    rank = np.unique(rows, return_inverse=True)[1].reshape(rows.shape).astype(np.int64)
    step = 1
    while step < width:
        pair = rank * (count * width + 1) + np.roll(rank, -step, axis=1)
        rank = np.unique(pair, return_inverse=True)[1].reshape(rows.shape).astype(np.int64)
        step *= 2
    order = np.argsort(rank.ravel(), kind="stable")
    return Transform(np.roll(rows, 1, axis=1).ravel()[order], order)


@dataclass
class Merged:
    """``interval``: number of the repeated interval of every flat (row, column) index;

    ``common``: symbols shared by neighbours in merged order, counted up to the depth.
    """

    interval: np.ndarray
    common: np.ndarray


def merge(shards: list[Transform], width: int, depth: int) -> Merged:
    """Merge transforms of rows of one ``width`` until they are sorted by ``depth`` symbols."""
    sizes = [len(s.symbols) for s in shards]
    total = sum(sizes)
    symbols = np.concatenate([s.symbols for s in shards]).astype(np.uint64)
    source = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    block = np.zeros(total, dtype=np.int64)
    common = np.full(total, depth, dtype=np.int64)
    if total:
        common[0] = 0
    place = np.arange(total, dtype=np.uint64)
    for passed in range(1, depth + 1):
        before = np.empty(total, dtype=np.uint64)
        before[np.argsort(source, kind="stable")] = symbols
        sent = np.sort(before << np.uint64(32) | place)
        came = (sent & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first, old = sent >> np.uint64(32), block[came]
        parts = np.zeros(total, dtype=bool)
        parts[1:] = (first[1:] != first[:-1]) | (old[1:] != old[:-1])
        common[parts & (common == depth)] = passed - 1
        source, block = source[came], np.cumsum(parts)
    bases = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    rotations = np.concatenate([s.rotations + b for s, b in zip(shards, bases)]) if shards else np.zeros(0, np.int64)
    interval = np.empty(total, dtype=np.int64)
    interval[rotations] = block[np.argsort(source, kind="stable")]
    return Merged(interval, common)
