"""Where two equal stretches of text are cut alike, wherever they stand.

Every window of ``length`` bytes is assigned to the smallest hashed gram among
its first bytes (its anchor). That choice depends on the bytes of the window
alone, so equal windows have equal anchors at equal offsets, and all windows can
be compared anchor by anchor: a repeat never crosses two groups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from parceltide.llm.bytes_math import CHUNK_BYTES, Joined, mixed, run_hashes

GRAM = 16
BLOCK = 16  # bytes of a symbol in the transforms
_PLACE_BITS = np.uint64(24)


@dataclass(frozen=True)
class Cut:
    """Sizes that follow from the repeat length."""

    length: int

    def __post_init__(self):
        if self.length < 4 * BLOCK:
            raise ValueError(f"repeats need at least {4 * BLOCK} bytes")

    @property
    def reach(self) -> int:
        """An anchor lies at most so many bytes after the start of its window."""
        return BLOCK * min(15, self.length // (3 * BLOCK))

    @property
    def blocks(self) -> int:
        return -(-(self.reach + self.length) // BLOCK)

    @property
    def core(self) -> int:
        """Whole blocks inside any window, wherever it starts."""
        return (self.length - BLOCK + 1) // BLOCK


@dataclass
class Runs:
    """Runs of window starts with one anchor: text index, first and last start, anchor, two hashes."""

    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    group: np.ndarray  # hash of the bytes that all windows of the run share
    segment: np.ndarray  # hash of all bytes of the run and of its shape


def _pieces(texts: list[bytes], length: int):
    """(text, offset, bytes) parts of bounded size that together hold every window once."""
    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, CHUNK_BYTES):
            yield i, at, text[at : at + CHUNK_BYTES + length - 1]


def window_runs(texts: list[bytes], cut: Cut) -> Runs:
    """All windows of the texts as runs; a text shorter than ``length`` has none."""
    out, held, size = [], [], 0
    for piece in _pieces(texts, cut.length):
        if held and size + len(piece[2]) > 2 * CHUNK_BYTES:
            out.append(_runs_of(held, cut))
            held, size = [], 0
        held.append(piece)
        size += len(piece[2])
    if held:
        out.append(_runs_of(held, cut))
    if not out:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.view(np.uint64), none.view(np.uint64))
    return Runs(*(np.concatenate(columns) for columns in zip(*out)))


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i : i + width], from running minima inside blocks of that width."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _runs_of(pieces: list[tuple[int, int, bytes]], cut: Cut) -> tuple[np.ndarray, ...]:
    joined = Joined([p[2] for p in pieces])
    buffer = joined.buffer
    at = np.arange(len(buffer) - GRAM + 1)
    grams = run_hashes(buffer, at, at + GRAM)
    # the place in the low bits makes the leftmost of equal grams the smallest
    keys = (grams >> _PLACE_BITS << _PLACE_BITS) | at.astype(np.uint64)
    anchors = (_sliding_minimum(keys, cut.reach + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)

    usable = np.zeros(len(buffer) + 1, dtype=np.int8)
    ends = joined.starts[1:] - 1
    usable[joined.starts[:-1]] += 1
    usable[ends - cut.length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(usable[:-1]) > 0)
    chosen = anchors[starts]
    # starts of two pieces never touch: at least length - 1 bytes lie between them
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1))))
    first = starts[new]
    last = starts[np.concatenate((new[1:] - 1, [len(starts) - 1]))]
    anchor = chosen[new]
    piece = joined.owner(first)
    shape = ((anchor - first) << 16 | (last - first)).astype(np.uint64)
    group = run_hashes(buffer, anchor, anchor + cut.length - cut.reach)
    segment = mixed(run_hashes(buffer, first, last + cut.length) ^ mixed(shape))
    owner = np.array([p[0] for p in pieces], dtype=np.int64)[piece]
    shift = np.array([p[1] for p in pieces], dtype=np.int64)[piece] - joined.starts[piece]
    return owner, first + shift, last + shift, anchor + shift, group, segment
