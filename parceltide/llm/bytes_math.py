"""Vectorised work on batches of UTF-8 texts inside tasks.

Texts of an Arrow batch are cut into chunks of bounded size, joined with a
newline after each, and treated as one byte array: word borders, word hashes
and window hashes are then whole-array operations, whatever the text lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
# Texts joined at once: what is worked out per byte takes some forty times as much memory, in every task's worker.
TEXT_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def text_chunks(column: pa.Array, limit: int = TEXT_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) runs of at most ``limit`` bytes or one text; null is empty."""
    first, held, texts = 0, 0, []
    for i, value in enumerate(column.cast(pa.large_binary())):
        text = value.as_py() or b""
        if texts and held + len(text) > limit:
            yield first, texts
            first, held, texts = i, 0, []
        texts.append(text)
        held += len(text) + 1
    if texts:
        yield first, texts


class Joined:
    """A chunk of texts as one byte array; ``starts`` has one entry more than there are texts."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.starts = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.count = len(texts)

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """Index of the text that holds each position."""
        return np.searchsorted(self.starts, positions, side="right") - 1

    def per_text(self, owners: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owners, weights=weights, minlength=self.count).astype(np.int64)

    def runs(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every maximal run of bytes flagged in the 256-entry table.

        The newline must not be a member, so that no run crosses a text.
        """
        flags = np.zeros(len(self.buffer) + 2, dtype=np.int8)
        flags[1:-1] = members[self.buffer]
        steps = np.diff(flags)
        return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Flags of the bytes outside the given inclusive ranges."""
    table = np.ones(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = False
    return table


def lower_ascii(buffer: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[buffer]


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BASE_INVERSE):
        row = np.full(length, base, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def _powers_for(length: int) -> tuple[np.ndarray, np.ndarray]:
    few = 2 * TEXT_BYTES
    return _powers(few if length <= few else max(2 * CHUNK_BYTES, 1 << (length - 1).bit_length()))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (splitmix finaliser)."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def run_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of buffer[start:end] for all pairs, from one prefix sum."""
    power, inverse = _powers_for(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[: len(buffer)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of words[i : i + size] for every i that has a whole window."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        out = out * _BASE + words[k : k + count]
    return mixed(out)


def covered(starts: np.ndarray, size: int | np.ndarray, length: int) -> np.ndarray:
    """Flags of the positions inside any [start, start + size)."""
    edges = np.zeros(length + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + size, length), -1)
    return np.cumsum(edges[:-1]) > 0


def found_twice(groups: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Flags of the entries whose (group, hash) occurs at least twice; groups are ascending."""
    key = mixed(hashes + groups.astype(np.uint64) * _BASE)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(key), dtype=bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags
