"""Numbers that describe a text: shares of byte classes, words, repetitions and lines."""

from __future__ import annotations

import numpy as np

from parceltide.llm.bytes_math import Joined, byte_table, found_twice, run_hashes, window_hashes

_WORD = byte_table((0x20, 0x20), (0x09, 0x0D))
_HEAD = byte_table((0x80, 0xBF))


def _members(text: str) -> np.ndarray:
    return ~byte_table(*[(ord(c), ord(c)) for c in text])


_CLASSES = {
    "upper": ~byte_table((0x41, 0x5A)), "lower": ~byte_table((0x61, 0x7A)), "digit": ~byte_table((0x30, 0x39)),
    "beyond_ascii": ~byte_table((0x80, 0xFF)), "space": ~byte_table((0x20, 0x20), (0x09, 0x0D)),
    "stops": _members(".,;:?"), "shouts": _members("!"), "bars": _members("|"), "signs": _members("#*$%&<>{}[]\\^~_=+@/"),
    "quotes": _members("'\"()-"),
}
NAMES = (
    "log_words", "log_bytes", "mean_word", "longest_word", "short_words", "long_words", *(f"{c}_share" for c in _CLASSES),
    "capitalised", "ends_in_stop", "distinct_words", "repeats_word", "repeats_two", "repeats_four", "lines_per_word",
    "double_lines", "longest_line", "byte_entropy",
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _largest(owner: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    out = np.zeros(count, dtype=np.float64)
    np.maximum.at(out, owner, values)
    return out


def measure(texts: list[bytes]) -> np.ndarray:
    """One row of ``NAMES`` per text; an empty text has zeros only."""
    joined = Joined(texts)
    buffer, count = joined.buffer, joined.count
    sizes = np.array([len(t) for t in texts], dtype=np.float64)
    starts, ends = joined.runs(_WORD)
    owner = joined.owner(starts)
    n_words = np.bincount(owner, minlength=count).astype(np.float64)
    per = lambda flags: np.bincount(owner[flags], minlength=count)
    heads = np.concatenate(([0], np.cumsum(_HEAD[buffer])))
    letters = heads[ends] - heads[starts]
    words = run_hashes(buffer, starts, ends)
    columns = [
        np.log1p(n_words), np.log1p(sizes), _share(np.bincount(owner, weights=letters, minlength=count), n_words),
        _largest(owner, letters, count), _share(per(letters <= 3), n_words), _share(per(letters >= 13), n_words),
    ]
    spread = np.repeat(np.arange(count) * 256, np.diff(joined.starts)) + buffer
    times = np.bincount(spread, minlength=256 * count).reshape(count, 256)
    times[:, 10] -= 1  # the newline after each text is not of it
    columns += [_share(times @ table, sizes) for table in _CLASSES.values()]
    columns.append(_share(per(_CLASSES["upper"][buffer[starts]]), n_words))
    columns.append(_share(per(_CLASSES["stops"][buffer[ends - 1]]), n_words))
    order = np.lexsort((words, owner))
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    columns.append(_share(np.bincount(owner[order][new], minlength=count), n_words))
    beside = np.zeros(len(words), dtype=bool)
    beside[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    columns.append(_share(per(beside), n_words))
    for size in (2, 4):
        windows = window_hashes(words, size)
        inside = np.flatnonzero(owner[: len(windows)] == owner[size - 1 :]) if len(windows) else np.zeros(0, np.int64)
        twice = inside[found_twice(owner[inside], windows[inside])]
        columns.append(_share(np.bincount(owner[twice], minlength=count), n_words))
    line_ends = np.flatnonzero(buffer == 10)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1))
    full = line_ends > line_starts
    line_starts, line_ends = line_starts[full], line_ends[full]
    line_owner = joined.owner(line_starts)
    lines = np.bincount(line_owner, minlength=count).astype(np.float64)
    columns.append(_share(lines, n_words))
    same = found_twice(line_owner, run_hashes(buffer, line_starts, line_ends))
    columns.append(_share(np.bincount(line_owner[same], minlength=count), lines))
    columns.append(_share(_largest(line_owner, line_ends - line_starts, count), sizes))
    share = _share(times, sizes[:, None])
    columns.append(-(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1))
    return np.stack(columns, axis=1)
