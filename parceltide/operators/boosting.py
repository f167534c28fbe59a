"""Second-order boosted trees: regularised leaves, pruned splits, histograms by one aggregate per level.

Rows are binned once and stored in blocks of a few thousand. A level of a tree costs one
pass of one small job: tasks sum gradient and hessian per (node, feature, bin), Spark adds the sums up, and
the driver, which only sees those sums, picks the splits. Their number is bounded by
nodes x features x bins, whatever the number of rows. Leaf values and the loss reduction of
a split come from the same sums. Sums are whole numbers (fixed point), so that a fit does
not depend on the order in which tasks finish.

A task lays its blocks down as files in Spark's own folder of its machine and streams them in each pass, so that no
pass sends rows to Python. The first pass of a tree adds the tree before to the scores and keeps the slopes for the
passes that follow. A pass that does not find its files, since a machine was lost, says so; the files are then made again from the
stored blocks and the trees, and the tree begins anew.

Features of two bins of which no row has more than one in its upper bin, such as the columns of a one-hot
vector, share a lane: one number per row that names the feature. Of two children only the lighter
one is summed up; the other one is the rest of its parent. Lanes are counted some at a time, as one number of a few thousand, and their
own sums are added up from those. All of this gives the same sums as whole numbers.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from parceltide.operators.selection import POINTS, Points
from parceltide.session import batches, stage

BLOCK_ROWS = 4096
PARTITION_BLOCKS = 32
TASK_BLOCKS = 4096  # at most in a task, which streams them
TOGETHER = 4  # blocks that a task works on at once
JOINT = 4096  # numbers of lanes that are counted together
DIRECT_TASKS = 32  # whose sums the driver adds up by itself
MOST_LOSSES = 4  # of files, in a row, within one tree
REFRESH = 8  # trees whose values are added up before they are added to the scores


@dataclass(frozen=True)
class Boosting:
    """``penalty`` is added to the hessian sum of a leaf, a split must reduce the loss by ``least_gain``,
    and both its sides need a hessian sum of ``least_weight``."""

    rounds: int = 400
    depth: int = 2
    rate: float = 0.03
    row_share: float = 0.8
    column_share: float = 0.8
    least_weight: float = 5.0
    penalty: float = 5.0
    least_gain: float = 0.1
    bins: int = 256
    seed: int = 42


@dataclass
class Tree:
    """A complete binary tree in heap order: node n has the children 2n+1 and 2n+2.

    Rows with x < cut go left. A node that is not split has feature -1 and passes all rows to the left.
    """

    features: list[int]
    cuts: list[float]
    bins: list[int]  # first bin of the right side
    values: list[float]  # of the leaves, left to right

    @property
    def depth(self) -> int:
        return max(((n + 1).bit_length() for n, f in enumerate(self.features) if f >= 0), default=0)


def leaf_value(g, h, penalty: float):
    return -g / (h + penalty)


def split_gains(g: np.ndarray, h: np.ndarray, how: Boosting) -> np.ndarray:
    """Loss reduction of every cut of the bins along the last axis; -inf where a side weighs too little."""
    gl, hl = np.cumsum(g, axis=-1)[..., :-1], np.cumsum(h, axis=-1)[..., :-1]
    total_g, total_h = g.sum(axis=-1)[..., None], h.sum(axis=-1)[..., None]
    part = lambda a, b: a * a / (b + how.penalty)
    gains = part(gl, hl) + part(total_g - gl, total_h - hl) - part(total_g, total_h)
    light = (hl < how.least_weight) | (total_h - hl < how.least_weight)
    return np.where(light, -np.inf, gains)


def _below(node: int, depth: int) -> list[int]:
    """Positions of the leaves below a node of a tree of this depth."""
    nodes = [node]
    while nodes[0] < 2**depth - 1:
        nodes = [k for n in nodes for k in (2 * n + 1, 2 * n + 2)]
    return [n - (2**depth - 1) for n in nodes]


def pruned(features: list[int], gains: dict[int, float], least_gain: float) -> list[int]:
    """Bottom-up: a split between two leaves that gains less than ``least_gain`` collapses."""
    out = list(features)
    for node in reversed(range(len(out))):
        kids = [k for k in (2 * node + 1, 2 * node + 2) if k < len(out)]
        if out[node] >= 0 and all(out[k] < 0 for k in kids) and gains[node] < least_gain:
            out[node] = -1
    return out


@dataclass(frozen=True)
class Lanes:
    """Where the bins of every feature are: in a lane of its own, or as the number ``code`` of a shared lane."""

    lane: list[int]
    code: list[int]  # 0 in a lane of its own
    many: list[int]  # numbers a lane can hold

    def joint(self) -> list[list[int]]:
        """Lanes that are counted together, so that their numbers make up one of at most ``JOINT``; the largest first."""
        groups: list[tuple[int, list[int]]] = []
        for lane in sorted(range(len(self.many)), key=lambda k: (-self.many[k], k)):
            at = next((k for k, (size, _) in enumerate(groups) if size * self.many[lane] <= JOINT), None)
            if at is None:
                groups.append((self.many[lane], [lane]))
            else:
                groups[at] = groups[at][0] * self.many[lane], [*groups[at][1], lane]
        return [lanes for _, lanes in groups]

    def tests(self, tree: Tree) -> list[tuple[int, int, int, int, int] | None]:
        """Per node (joint number, what to divide it by, numbers of the lane or 0 if nothing is above it, code,
        first bin of the right side), None where the node is not split."""
        at = {}
        for number, lanes in enumerate(self.joint()):
            stride = 1
            for lane in reversed(lanes):
                at[lane] = number, stride, self.many[lane] if lane != lanes[0] else 0
                stride *= self.many[lane]
        return [(*at[self.lane[f]], self.code[f], b) if f >= 0 else None for f, b in zip(tree.features, tree.bins)]


def _leaf(right: list[np.ndarray | None]):
    """Number of the leaf of every row; ``right`` tells per node which rows go right. Choices are made bit by bit."""
    kind = np.uint8 if len(right) < 256 else np.uint16

    def below(node: int):
        if node >= len(right):
            return kind(node - len(right))
        left = below(2 * node + 1)
        if right[node] is None:
            return left
        return left ^ ((left ^ below(2 * node + 2)) & np.negative(right[node].astype(kind)))

    return below(0)


def _goes_right(test: tuple[int, int, int, int, int], joint: np.ndarray) -> np.ndarray:
    number, stride, many, code, first = test
    bins = joint[number] // np.uint16(stride) if stride > 1 else joint[number]
    if many:
        bins = bins - bins // np.uint16(many) * np.uint16(many)
    return bins == code if code else bins >= first


def _leaves(tests: list, joint: np.ndarray):
    return _leaf([None if t is None else _goes_right(t, joint) for t in tests])


def _slopes(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 0.5 * (1.0 + np.tanh(0.5 * margin))
    return weight * (p - label), weight * np.maximum(p * (1.0 - p), 1e-16)


def _drawn(block: int, rows: int, turn: int, how: Boosting) -> np.ndarray:
    """Which rows of a block a tree sees: a generator per (seed, tree, block)."""
    if how.row_share >= 1.0:
        return np.ones(rows, dtype=bool)
    return np.random.default_rng([how.seed, turn, block]).random(rows) < how.row_share


def _matrix(features: pa.Array) -> np.ndarray:
    return features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1)


def _next_upper(cuts: list[np.ndarray], two: np.ndarray):
    """Per feature of two bins the next one that shares an upper bin with it in any row of the task; their number if none."""
    edges = np.array([cuts[k][0] for k in two])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = np.full(len(two), len(two))
        for batch in filter(lambda b: b.num_rows, batches):
            rows, upper = np.nonzero(_matrix(batch.column(0)).take(two, axis=1) >= edges)
            same = rows[1:] == rows[:-1]
            np.minimum.at(after, upper[:-1][same], upper[1:][same])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(two))), pa.array(after)], ["pos", "after"])

    return run


def shared_lanes(rows: DataFrame, cuts: list[np.ndarray], bins: int) -> Lanes:
    """Runs of features of two bins share a lane where no row of all the rows has two of them in their upper bin."""
    two = np.array([k for k, c in enumerate(cuts) if len(c) == 1], dtype=np.int64)
    found = {
        r["pos"]: r["after"] for r in rows.select("x").mapInArrow(_next_upper(cuts, two), "pos long, after long")
        .groupBy("pos").agg(F.min("after").alias("after")).collect()
    } if len(two) else {}
    lane, code, many = [0] * len(cuts), [0] * len(cuts), []
    for k, c in enumerate(cuts):
        if len(c) != 1:
            lane[k] = len(many)
            many.append(len(c) + 1)
    start, stop = 0, 0  # the run and the first feature that may not join it
    for k, feature in enumerate(two):
        if k == 0 or k >= stop or k - start >= bins - 1:
            start, stop = k, len(two)
            many.append(1)
        stop = min(stop, found.get(k, len(two)))
        lane[feature], code[feature] = len(many) - 1, k - start + 1
        many[-1] += 1
    return Lanes(lane, code, many)


def _binned(cuts: list[np.ndarray], where: Lanes):
    """A byte per lane of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(lambda b: b.num_rows, batches):
            ids, features, label, weight = batch.columns
            lanes = np.zeros((len(where.many), len(ids)), dtype=np.uint8)
            for values, c, lane, code in zip(np.ascontiguousarray(_matrix(features).T), cuts, where.lane, where.code):
                if len(c) == 1:
                    lanes[lane] += (values >= c[0]).astype(np.uint8) * np.uint8(code or 1)
                elif len(c):
                    lanes[lane] = np.searchsorted(c, values, side="right")
            ends = np.arange(len(ids) + 1, dtype=np.int32) * len(where.many)
            bins = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(lanes.T.tobytes())])
            yield pa.RecordBatch.from_arrays([ids, bins, label, weight], ["id", "bins", "label", "weight"])

    return run


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch of rows as a block: a row of bytes per lane."""
    for batch in filter(lambda b: b.num_rows, batches):
        ids, bins, label, weight = batch.columns
        lanes = np.frombuffer(b"".join(bins.to_pylist()), np.uint8).reshape(len(ids), -1).T
        numbers = np.stack((label.to_numpy(), weight.to_numpy())).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[0].as_py()]), pa.array([len(ids)]), pa.array([lanes.tobytes()], pa.binary()),
             pa.array([numbers.tobytes()], pa.binary())], ["block", "n", "bins", "numbers"],
        )


def _laid_down(where: Lanes):
    """Writes the blocks of a task to files beside each other, some joined at a time; tells their folder."""
    groups = where.joint()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folders = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")  # Spark removes them at its end
        folder = tempfile.mkdtemp(prefix="boosting-", dir=folders[os.getpid() % len(folders)])
        parts, some = [], []
        with open(f"{folder}/lanes", "wb") as lanes_file, open(f"{folder}/known", "wb") as known_file:

            def write() -> None:
                lanes = np.hstack([np.frombuffer(bins, np.uint8).reshape(-1, n) for _, n, bins, _ in some])
                for group in groups:
                    number = lanes[group[0]].astype(np.uint16)
                    for lane in group[1:]:
                        number = number * np.uint16(where.many[lane]) + lanes[lane]
                    number.tofile(lanes_file)
                np.hstack([np.frombuffer(numbers).reshape(2, n) for _, n, _, numbers in some]).tofile(known_file)
                parts.append([(block, n) for block, n, _, _ in some])
                some.clear()

            for batch in batches:
                for row in zip(*(column.to_pylist() for column in batch.columns)):
                    some.append(row)
                    if len(some) == TOGETHER:
                        write()
            if some:
                write()
        with open(f"{folder}/parts", "w") as f:
            json.dump(parts, f)
        yield pa.RecordBatch.from_arrays([pa.array([folder])], ["folder"])

    return run


class _Sums:
    """Whole-number sums of gradient and hessian per (node, joint number)."""

    def __init__(self, nodes: int, groups: list[list[int]], many: list[int]):
        self.nodes, self.groups, self.many = nodes, groups, many
        self.sizes = [int(np.prod([many[k] for k in lanes])) for lanes in groups]
        self.sums = [np.zeros((2, nodes * size), dtype=np.int64) for size in self.sizes]

    def add(self, joint: np.ndarray, node: np.ndarray | None, g: np.ndarray, h: np.ndarray) -> None:
        """``joint`` holds a row per number; sums of the rows of one call stay below 2^53 and are exact."""
        for numbers, size, sums in zip(joint, self.sizes, self.sums):
            slot = numbers.astype(np.intp)
            if node is not None:
                slot += node * size
            for k, values in enumerate((g, h)):
                sums[k] += np.bincount(slot, values, minlength=self.nodes * size).astype(np.int64)

    def of_lanes(self, used: np.ndarray) -> np.ndarray:
        """(gradient or hessian, node, slots of the used lanes side by side)."""
        out = {}
        for lanes, sums in zip(self.groups, self.sums):
            whole = sums.reshape(2, self.nodes, *[self.many[k] for k in lanes])
            for axis, lane in enumerate(lanes, 2):
                out[lane] = whole.sum(axis=tuple(k for k in range(2, whole.ndim) if k != axis))
        return np.concatenate([out[k] for k in used], axis=-1)


def _streamed(folder: str, names: list[str], groups: int) -> Iterator[tuple]:
    """Joined blocks with their ids and lengths, joint numbers, and two rows of numbers per further file."""
    with open(f"{folder}/parts") as f:
        parts = json.load(f)
    files = [open(f"{folder}/{name}", "rb") for name in ("lanes", *names)]
    try:
        for blocks in parts:
            n = sum(n for _, n in blocks)
            yield blocks, np.fromfile(files[0], np.uint16, groups * n).reshape(groups, n), *[np.fromfile(f, count=2 * n).reshape(2, n) for f in files[1:]]
    finally:
        for f in files:
            f.close()


def _removed(folder: str, *names: str) -> None:
    for name in names:
        try:
            os.remove(f"{folder}/{name}")
        except FileNotFoundError:
            pass


def _found_or_lost(run):
    """Sums of the folders of a task, None where files are missing."""

    def over(folders: Iterator[str]) -> Iterator[np.ndarray | None]:
        try:
            yield run(list(folders))
        except FileNotFoundError:
            yield None

    return over


def _first_pass(trees: list, start: int, turn: int, used: np.ndarray, where: Lanes, how: Boosting, scale: float, refresh: int):
    """Adds the trees from ``start`` to ``turn`` to the scores, writes them and their slopes, and sums up the whole rows."""
    groups, many = where.joint(), where.many

    def run(folders: list[str]) -> np.ndarray:
        sums = _Sums(1, groups, many)
        for folder in folders:
            before = [f"scores-{start}"] if start else []
            scores, slopes = (tempfile.NamedTemporaryFile(dir=folder, delete=False) for _ in range(2))
            with scores, slopes:
                for blocks, joint, (label, weight), *last in _streamed(folder, ["known", *before], len(groups)):
                    score, since = last[0] if last else np.zeros((2, len(label)))
                    for k, (tests, values) in enumerate(trees, start + 1):
                        since += values[_leaves(tests, joint)]
                        if k % refresh == 0:
                            score += since
                            since[:] = 0.0
                    np.stack((score, since)).tofile(scores)
                    seen = np.concatenate([_drawn(block, k, turn, how) for block, k in blocks])
                    g, h = (np.rint(v * scale) * seen for v in _slopes(score + since, label, weight))
                    np.stack((g, h)).tofile(slopes)
                    sums.add(joint, None, g, h)
            os.replace(scores.name, f"{folder}/scores-{turn}")
            os.replace(slopes.name, f"{folder}/slopes-{turn}")
            _removed(folder, f"scores-{turn - 2}", f"slopes-{turn - 1}")
        return sums.of_lanes(used)

    return _found_or_lost(run)


def _next_pass(turn: int, partial: list, wanted: np.ndarray, used: np.ndarray, where: Lanes):
    """Sums up the rows of the nodes with a place in ``wanted``."""
    groups, many = where.joint(), where.many

    def run(folders: list[str]) -> np.ndarray:
        sums = _Sums(int(wanted.max()) + 1, groups, many)
        most, held, count = TOGETHER * BLOCK_ROWS, [], 0
        for folder in folders:
            for _, joint, (g, h) in _streamed(folder, [f"slopes-{turn}"], len(groups)):
                node = wanted[_leaves(partial, joint)]
                rows = np.flatnonzero((node >= 0) & ((g != 0.0) | (h != 0.0)))
                if count + len(rows) > most and held:
                    sums.add(*(np.concatenate(part, axis=-1) for part in zip(*held)))
                    held, count = [], 0
                held.append((joint.take(rows, axis=1), node[rows], g[rows], h[rows]))
                count += len(rows)
        if held:
            sums.add(*(np.concatenate(part, axis=-1) for part in zip(*held)))
        return sums.of_lanes(used)

    return _found_or_lost(run)


class _Lost(Exception):
    """A pass did not find the files of its rows."""


def _both(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    return None if a is None or b is None else a + b


def _summed(places: RDD, one_pass, columns, used: np.ndarray, where: Lanes, how: Boosting) -> np.ndarray:
    """Whole-number sums (gradient or hessian, wanted node, column, bin)."""
    many = np.array([where.many[k] for k in used])
    # a task's sums are at most nodes x columns x bins numbers; those of many tasks meet in a few before the driver
    parts = places.mapPartitions(one_pass)
    found = parts.reduce(_both) if places.getNumPartitions() <= DIRECT_TASKS else parts.treeReduce(_both)
    if found is None:
        raise _Lost
    low = dict(zip(used.tolist(), (np.cumsum(many) - many).tolist()))
    out = np.zeros((2, found.shape[1], len(columns), how.bins), dtype=np.int64)
    total = found[:, :, : many[0]].sum(axis=-1)
    for k, c in enumerate(columns):
        start = low[where.lane[c]]
        if where.code[c]:
            out[:, :, k, 1] = found[:, :, start + where.code[c]]
            out[:, :, k, 0] = total - out[:, :, k, 1]
        else:
            out[:, :, k, : where.many[where.lane[c]]] = found[:, :, start : start + where.many[where.lane[c]]]
    return out


def _level_sums(above: np.ndarray | None, features: list[int], first: list[int], columns: np.ndarray, summed) -> np.ndarray:
    """Sums of all nodes of a level: of the lighter child of every split by a pass, of the other one as the rest of its parent."""
    if above is None:
        return summed(np.zeros(1, dtype=np.int64))
    parents = above.shape[1]
    done = parents - 1
    wanted = np.full(2 * parents, -1, dtype=np.int64)
    for k in range(parents):
        if (f := features[done + k]) >= 0:
            sides = above[1, k, int(np.searchsorted(columns, f))]
            lighter = 2 * k + int(sides[: first[done + k]].sum() > sides[first[done + k] :].sum())
            wanted[lighter] = wanted.max() + 1
    found = summed(wanted)
    out = np.zeros((2, 2 * parents, *above.shape[2:]), dtype=np.int64)
    for k in range(parents):
        if features[done + k] < 0:
            out[:, 2 * k] = above[:, k]
            continue
        own = 2 * k + int(wanted[2 * k] < 0)
        out[:, own] = found[:, wanted[own]]
        out[:, own ^ 1] = above[:, k] - out[:, own]
    return out


def grow(places: RDD, trees: list[Tree], start: int, cuts: list[np.ndarray], where: Lanes, how: Boosting, scale: float) -> Tree:
    """The next tree: level by level the best cut of every node, then pruning, then leaf values.

    The scores beside the blocks hold the trees before ``start``.
    """
    turn = len(trees)
    rng = np.random.default_rng([how.seed, turn])
    many = max(1, round(how.column_share * len(cuts)))
    columns = np.sort(rng.choice(len(cuts), many, replace=False))
    size = 2**how.depth - 1
    features, first, gains = [-1] * size, [0] * size, {}
    sums: dict[int, tuple[float, float]] = {}
    used = np.unique([where.lane[c] for c in columns])
    known = [(where.tests(tree), np.array(tree.values)) for tree in trees[start:]]
    whole = None

    def summed(wanted: np.ndarray) -> np.ndarray:
        one_pass = (
            _next_pass(turn, partial, wanted, used, where) if partial
            else _first_pass(known, start, turn, used, where, how, scale, REFRESH)
        )
        return _summed(places, one_pass, columns, used, where, how)

    for level in range(how.depth):
        done = 2**level - 1
        partial = where.tests(Tree(features[:done], [], first[:done], [])) if level else []
        whole = _level_sums(whole, features, first, columns, summed)
        g, h = whole / scale
        gain = split_gains(g, h, how)
        for k in range(1 << level):
            node = done + k
            if level == 0:
                sums[0] = (g[0, 0].sum(), h[0, 0].sum())
            best = int(gain[k].argmax())
            column, cut = divmod(best, how.bins - 1)
            if not gain[k].flat[best] > 0:
                sums[2 * node + 1], sums[2 * node + 2] = sums[node], (0.0, 0.0)
                continue
            features[node], first[node], gains[node] = int(columns[column]), cut + 1, float(gain[k].flat[best])
            left = (g[k, column, : cut + 1].sum(), h[k, column, : cut + 1].sum())
            sums[2 * node + 1] = left
            sums[2 * node + 2] = (sums[node][0] - left[0], sums[node][1] - left[1])
        if all(f < 0 for f in features[done : 2 * done + 1]):
            break
    kept = pruned(features, gains, how.least_gain)
    values = [0.0] * (1 << how.depth)

    def settle(node: int) -> None:
        if node < size and kept[node] >= 0:
            settle(2 * node + 1)
            settle(2 * node + 2)
        else:
            for leaf in _below(node, how.depth):
                values[leaf] = how.rate * float(leaf_value(*sums[node], how.penalty))

    settle(0)
    edges = [float(cuts[f][b - 1]) if f >= 0 else 0.0 for f, b in zip(kept, first)]
    return Tree(kept, edges, [b if f >= 0 else 0 for f, b in zip(kept, first)], values)


def _points(dims: int):
    """Per feature the points of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, some, count = [Points() for _ in range(dims)], [], 0

        def take() -> None:
            columns = np.ascontiguousarray(np.concatenate(some).T)
            low, high = columns.min(axis=1), columns.max(axis=1)
            between = ((columns > low[:, None]) & (columns < high[:, None])).any(axis=1)
            upper = (columns == high[:, None]).sum(axis=1)
            for k, column in enumerate(columns):
                if between[k]:
                    points[k].add(*np.unique(column, return_counts=True))
                else:
                    points[k].add(np.array([low[k], high[k]]), np.array([len(column) - upper[k], upper[k]]))
            some.clear()

        for batch in filter(lambda b: b.num_rows, batches):
            some.append(_matrix(batch.column(0)))
            count += batch.num_rows
            if count >= POINTS:
                take()
                count = 0
        if some:
            take()
        for pos, known in enumerate(points):
            if known.held:
                values, counts = known.merged()
                yield pa.RecordBatch.from_arrays([pa.array([pos]), pa.array([values]), pa.array([counts])], ["pos", "values", "counts"])

    return run


def _cuts(bins: int):
    """Cuts of the features whose points a task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points: dict[int, Points] = {}
        for batch in batches:
            for k, pos in enumerate(batch.column(0).to_pylist()):
                values, counts = (batch.column(c)[k].values.to_numpy() for c in (1, 2))
                points.setdefault(pos, Points()).add(values, counts)
        for pos, known in points.items():
            values, counts = known.merged()
            values, counts = values[counts > 0], counts[counts > 0]
            ends = np.cumsum(counts)
            cuts = values[np.searchsorted(ends, np.ceil(np.arange(1, bins) / bins * ends[-1]))] if len(values) > 2 else values
            cuts = np.unique([*cuts, values[-1]])
            yield pa.RecordBatch.from_arrays([pa.array([pos]), pa.array([cuts[cuts > values[0]][: bins - 1]])], ["pos", "cuts"])

    return run


def cut_points(rows: DataFrame, dims: int, bins: int) -> list[np.ndarray]:
    """Ascending cuts of every feature at its quantiles, at most bins - 1; its least value is none.

    The only cut of a feature of two values is the larger one. One pass sums every feature up as points, which
    meet in a task per feature.
    """
    spark = rows.sparkSession
    with batches(spark, 1000, 4 << 20):
        found = {
            r["pos"]: np.array(r["cuts"], dtype=float)
            for r in rows.select("x").mapInArrow(_points(dims), "pos long, values array<double>, counts array<double>")
            .repartition(min(dims, spark.sparkContext.defaultParallelism), "pos").mapInArrow(_cuts(bins), "pos long, cuts array<double>").collect()
        }  # one row per feature
    return [found.get(k, np.zeros(0)) for k in range(dims)]


_BINNED = "id long, bins binary, label double, weight double"
_BLOCK = "block long, n long, bins binary, numbers binary"


def _kept(places: RDD) -> RDD:
    """Kept, so that tasks run where their files are; what is lost is made again from the stored blocks."""
    held = places.persist(StorageLevel.MEMORY_AND_DISK)
    held.count()
    return held


def _held(stored: DataFrame, where: Lanes) -> RDD:
    """Folders of stored blocks, dealt over all cores, or at ``TASK_BLOCKS`` a task over more."""
    count = stored.count()
    spark = stored.sparkSession
    parts = max(-(-count // TASK_BLOCKS), min(count, spark.sparkContext.defaultParallelism))
    with batches(spark, TOGETHER):
        return _kept(stored.repartition(parts).mapInArrow(_laid_down(where), "folder string").rdd.map(lambda r: r["folder"]))


def _let_go(places: RDD) -> None:
    places.foreach(lambda folder: shutil.rmtree(folder, ignore_errors=True))
    places.unpersist()


def fit_trees(rows: DataFrame, how: Boosting) -> list[Tree]:
    """Trees over (x array<double>, label double, weight double); x has no gaps.

    Scores start at 0, a share of one half, which is right for weights that balance the classes.
    """
    stored = stage(rows.select("x", "label", "weight"), "fit")
    size = stored.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims"), F.max("weight").alias("weight")).first()
    if not size["n"]:
        return []
    cuts = cut_points(stored, size["dims"], how.bins)
    where = shared_lanes(stored, cuts, how.bins)
    parts = max(1, -(-size["n"] // (BLOCK_ROWS * PARTITION_BLOCKS)))
    with batches(rows.sparkSession, BLOCK_ROWS):  # a batch is a block
        blocks = stage(
            stored.select(F.monotonically_increasing_id().alias("id"), "x", "label", "weight").mapInArrow(_binned(cuts, where), _BINNED)
            .repartition(parts, "id").sortWithinPartitions("id").mapInArrow(_blocked, _BLOCK), "blocks"
        )
    scale = 2.0 ** min(36, int(52 - np.log2(TOGETHER * BLOCK_ROWS * max(size["weight"], 1.0))), int(61 - np.log2(size["n"] * max(size["weight"], 1.0))))
    trees: list[Tree] = []
    places = _held(blocks, where)
    start, losses = 0, 0
    while len(trees) < how.rounds:
        try:
            trees.append(grow(places, trees, start, cuts, where, how, scale))
            start, losses = len(trees) - 1, 0
        except _Lost:
            losses += 1
            if losses > MOST_LOSSES:
                raise RuntimeError("the files of the rows are lost again and again") from None
            _let_go(places)
            places, start = _held(blocks, where), 0
    _let_go(places)
    return trees


def margins(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    """Sums of leaf values of raw feature rows."""
    out, columns = np.zeros(len(x)), np.ascontiguousarray(x.T)
    for tree in trees:
        leaf = _leaf([columns[f] >= c if f >= 0 else None for f, c in zip(tree.features, tree.cuts)])
        out += np.array(tree.values)[leaf]
    return out


class _Columns(Params):
    """Columns as in the other classifiers of the pipelines."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    trees_json = Param(Params._dummy(), "trees_json", "fitted trees", TypeConverters.toString)
    how_json = Param(Params._dummy(), "how_json", "settings of the fit", TypeConverters.toString)


class BoostedTrees(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability``, a vector of both class probabilities."""

    @property
    def trees(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault(self.trees_json))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.trees

        @F.pandas_udf("double")
        def late(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_list()) if len(x) else np.zeros((0, 0))
            return pd.Series(0.5 * (1.0 + np.tanh(0.5 * margins(trees, rows))) if len(rows) else [], dtype=float)

        p = late(vector_to_array(self.getOrDefault(self.featuresCol)))
        return dataset.withColumn("probability", array_to_vector(F.array(1.0 - p, p)))


class SecondOrderBoosting(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``BoostedTrees`` on featuresCol, label and weight."""

    def __init__(self, how: Boosting | None = None, featuresCol: str = "features"):
        super().__init__()
        self._set(how_json=json.dumps(asdict(how or Boosting())), featuresCol=featuresCol)

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        how = Boosting(**json.loads(self.getOrDefault(self.how_json)))
        rows = dataset.select(
            vector_to_array(self.getOrDefault(self.featuresCol)).alias("x"), F.col("label").cast("double").alias("label"),
            F.col("weight").cast("double").alias("weight"),
        )
        model = BoostedTrees()
        model._set(
            trees_json=json.dumps([asdict(t) for t in fit_trees(rows, how)]), featuresCol=self.getOrDefault(self.featuresCol)
        )
        return model
