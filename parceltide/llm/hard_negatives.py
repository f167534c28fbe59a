"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors are put in order of label and Hilbert position and cut into blocks: one Parquet
row holds up to ``block_rows`` vectors of one label and, per dimension, their least and
largest component. Anchors are gathered in panels, in the same order. Interval
arithmetic over a zone bounds the inner product of an anchor with everything in the
block, so that a panel only reads the blocks in which a wanted score can lie:

1. positives: blocks of the anchor's label whose bound reaches the fifth best score
   that the anchor's own block offers;
2. negatives: blocks of other labels whose bounds meet a window of the anchor.

A panel meets its blocks best bound first, in slices of bounded size, and passes over
a block as soon as what it has found is better than the bound. All scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from parceltide.llm.hilbert import hilbert_keys
from parceltide.session import shuffle_width, stage

LEAST = np.iinfo(np.int64).min  # no score
MOST_SCORE = (2**63 - 1) // 100
MOST_COMPONENT = float(2**62)
NO_WINDOW = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Sizes:
    """Rows of a block, anchors of a panel, blocks of a slice, zones of a page; dimensions and bits of the curve."""

    block_rows: int = 512
    panel_rows: int = 512
    slice_blocks: int = 8
    page_zones: int = 1024
    curve_dims: int = 128
    curve_bits: int = 2


@dataclass(frozen=True)
class Wanted:
    """How many positives and negatives, and the window of a negative's score in percent of the positive's."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


# -- numbers


def _matrix(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of a list column, rows padded with zeros, and the lengths."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    with np.errstate(over="ignore"):
        values = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.clip(values, -MOST_COMPONENT, MOST_COMPONENT)
    return out, lengths


def _packed(matrix: np.ndarray) -> bytes:
    """Whole numbers in four bytes each where that is exact, else in eight."""
    small = matrix.astype(np.float32)
    return (small if (small == matrix).all() else matrix.astype(np.float64)).tobytes()


def _unpacked(data: bytes, rows: int) -> np.ndarray:
    """The matrix of ``_with_width``: its length tells four bytes a number from eight."""
    width = int(np.frombuffer(data[:8], np.int64)[0])
    body = data[8:]
    kind = np.float64 if width and len(body) == 8 * rows * width else np.float32
    return np.frombuffer(body, kind).reshape(rows, width).astype(np.float64)


def _with_width(matrix: np.ndarray) -> bytes:
    return np.int64(matrix.shape[1]).tobytes() + _packed(matrix)


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of all rows of whole numbers, the shorter ones padded with zeros; clipped to +-MOST_SCORE."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
    exact = whole(a) @ whole(b).T
    return np.clip(exact, -MOST_SCORE, MOST_SCORE).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest product of each row of ``a`` with any point of each box, a little widened for rounding."""
    width = min(a.shape[1], low.shape[1])
    plus, minus = np.maximum(a[:, :width], 0), np.minimum(a[:, :width], 0)
    low, high = low[:, :width], high[:, :width]
    slack = 1e-9 * (np.abs(a[:, :width]) @ np.maximum(np.abs(low), np.abs(high)).T)
    least, most = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    return least - slack, most + slack


def best(scores: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` largest scores of every row and their columns, the first column first among equals; LEAST fills up."""
    scores = scores.copy()
    rows = np.arange(len(scores))
    values = np.full((len(scores), many), LEAST)
    places = np.zeros((len(scores), many), dtype=np.int64)
    for k in range(many if scores.shape[1] else 0):
        at = scores.argmax(axis=1)
        values[:, k], places[:, k] = scores[rows, at], at
        scores[rows, at] = LEAST
    return values, places


# -- blocks


def _spread(batches: Iterator[pa.RecordBatch], scale: float, dims: int) -> Iterator[pa.RecordBatch]:
    count, total, square = 0, np.zeros(dims), np.zeros(dims)
    for batch in batches:
        matrix, _ = _matrix(batch.column(0), scale)
        part = matrix[:, :dims]
        count += len(part)
        total[: part.shape[1]] += part.sum(axis=0)
        square[: part.shape[1]] += (part**2).sum(axis=0)
    if count:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims)), pa.array(np.full(dims, float(count))), pa.array(total), pa.array(square)],
            ["dim", "n", "total", "square"],
        )


def _curve(rows: DataFrame, scale: float, sizes: Sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dimensions by falling spread, their means and deviations: at most ``curve_dims`` numbers each."""
    dims = sizes.curve_dims
    parts = rows.select("vector").mapInArrow(
        lambda batches: _spread(batches, scale, dims), "dim long, n double, total double, square double"
    )
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("square").alias("s")).collect()
    mean, var = np.zeros(dims), np.zeros(dims)
    for r in found:
        mean[r.dim] = r.t / r.n
        var[r.dim] = max(r.s / r.n - mean[r.dim] ** 2, 0.0)
    order = np.argsort(-var, kind="stable")
    order = order[var[order] > 0]
    return order, mean[order], np.sqrt(var[order])


def _levels(matrix: np.ndarray, order: np.ndarray, mean: np.ndarray, deviation: np.ndarray, bits: int) -> np.ndarray:
    """Every coordinate in 2 ** bits steps of its own spread, about equally full where values are bell-shaped."""
    wide = np.pad(matrix, ((0, 0), (0, max(0, int(order.max(initial=-1)) + 1 - matrix.shape[1]))))
    steps = np.tanh((wide[:, order] - mean) / deviation * 0.8) * 0.5 + 0.5
    return np.minimum((steps * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def _keyed(scale: float, curve, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, lengths = _matrix(batch.column(4), scale)
            keys = hilbert_keys(_levels(matrix, *curve, bits), bits)
            vectors = [_with_width(row[None, :n]) for row, n in zip(matrix, lengths)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(4)], pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())],
                ["row", "id", "label", "anchor", "key", "vector"],
            )

    return run


def _blocks(block_rows: int, positives: int):
    def block(number: int, held: list[tuple]) -> pa.RecordBatch:
        held.sort(key=lambda r: (r[1], r[0]))  # ties of a score go by id
        rows = np.array([r[0] for r in held], np.int64)
        matrix = _stacked([_unpacked(r[4], 1) for r in held])
        anchors = np.flatnonzero([r[3] for r in held])
        own = inner_products(matrix[anchors], matrix)
        own[np.arange(len(anchors)), anchors] = LEAST
        floor = best(own, positives)[0][:, -1]
        values = [
            (TaskContext.get().partitionId() << 32) + number, int(held[0][2]), len(held), len(anchors),
            np.array([r[1] for r in held], np.int64).tobytes(), rows.tobytes(), _with_width(matrix),
            _with_width(np.stack((matrix.min(axis=0), matrix.max(axis=0)))), anchors.astype(np.int32).tobytes(), floor.tobytes(),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values[:2]] + [
            pa.array([v], pa.int32()) for v in values[2:4]
        ] + [pa.array([v], pa.binary()) for v in values[4:]], _BLOCK_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0
        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in range(5)]):
                if held and (len(held) == block_rows or held[0][2] != row[2]):
                    yield block(number, held)
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield block(number, held)

    return run


_BLOCK = "block long, label long, n int, n_anchors int, ids binary, rows binary, matrix binary, zone binary, anchors binary, floors binary"
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def usable_rows(rows: DataFrame, id_column: str, vector_column: str, label: Column, anchor: Column) -> DataFrame:
    """(row, id, label, anchor, vector) without null ids, labels or vectors and without null or non-finite components."""
    finite = F.forall(
        F.col(vector_column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    )
    return rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.when(finite, F.col(vector_column).cast("array<double>")).alias("vector"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")


def blocks_of(rows: DataFrame, scale: float, sizes: Sizes = Sizes(), positives: int = 5) -> DataFrame:
    """The stored block table of ``usable_rows``, one row per block."""
    rows = stage(rows, "usable")
    curve = _curve(rows, scale, sizes)
    keyed = stage(rows.mapInArrow(
        _keyed(scale, curve, sizes.curve_bits), "row long, id long, label long, anchor boolean, key binary, vector binary"
    ), "keyed")
    parts = max(1, -(-keyed.count() // (8 * sizes.block_rows)))
    ordered = keyed.repartitionByRange(parts, "label", "key", "id", "row").sortWithinPartitions("label", "key", "id", "row")
    return stage(ordered.coalesce(parts).select("row", "id", "label", "anchor", "vector").mapInArrow(
        _blocks(sizes.block_rows, positives), _BLOCK
    ), "blocks")


# -- panels of anchors

_PANEL = "panel long, ids binary, rows binary, labels binary, matrix binary, limits binary"
_PANEL_NAMES = [c.split()[0] for c in _PANEL.split(", ")]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, label, n, ids, rows, matrix, anchors, floors in zip(*[c.to_pylist() for c in batch.columns]):
            own = np.frombuffer(anchors, np.int32)
            points = _unpacked(matrix, n)[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), block)), pa.array(np.frombuffer(rows, np.int64)[own]),
                 pa.array(np.frombuffer(ids, np.int64)[own]), pa.array(np.full(len(own), label)),
                 pa.array(np.frombuffer(floors, np.int64)), pa.array([_with_width(p[None]) for p in points], pa.binary())],
                ["block", "row", "id", "label", "floor", "vector"],
            )


def _panels(panel_rows: int):
    def panel(number: int, held: list[tuple]) -> pa.RecordBatch:
        column = lambda k: np.array([r[k] for r in held], np.int64).tobytes()
        values = [column(2), column(1), column(3), _with_width(_stacked([_unpacked(r[5], 1) for r in held])), column(4)]
        name = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_arrays([pa.array([name])] + [pa.array([v], pa.binary()) for v in values], _PANEL_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                held.append(row)
                if len(held) == panel_rows:
                    yield panel(number, held)
                    held, number = [], number + 1
        if held:
            yield panel(number, held)

    return run


def panels_of(blocks: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Anchors of neighbouring blocks in panels; ``limits`` holds the floor of each anchor's positives."""
    many = blocks.agg(F.sum("n_anchors")).first()[0] or 0
    parts = max(1, -(-many // sizes.panel_rows))
    anchors = blocks.where("n_anchors > 0").select("block", "label", "n", "ids", "rows", "matrix", "anchors", "floors").mapInArrow(
        _anchor_rows, "block long, row long, id long, label long, floor long, vector binary"
    )
    ordered = anchors.repartitionByRange(parts, "block", "row").sortWithinPartitions("block", "row").coalesce(parts)
    return stage(ordered.mapInArrow(_panels(sizes.panel_rows), _PANEL), "panels")


class _Panel:
    def __init__(self, ids: bytes, rows: bytes, labels: bytes, matrix: bytes, limits: bytes):
        self.ids, self.rows, self.labels = (np.frombuffer(x, np.int64) for x in (ids, rows, labels))
        self.matrix = _unpacked(matrix, len(self.ids))
        self.limits = np.frombuffer(limits, np.int64)


# -- the two searches


class Positives:
    """The best rows of the anchor's own label."""

    def __init__(self, panel: _Panel, wanted: Wanted):
        self.panel, self.many = panel, wanted.positives
        self.found = np.full((len(panel.ids), 1, self.many), LEAST)
        self.names = np.zeros((len(panel.ids), 1, self.many, 2), np.int64)

    def reach(self, least: np.ndarray, most: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Flags (anchor, block): whether a score of the block can still be wanted."""
        floor = np.maximum(self.panel.limits, self.found[:, 0, -1])
        return (self.panel.labels[:, None] == labels) & (most >= floor[:, None])

    def take(self, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = np.where(rows == self.panel.rows[anchors, None], LEAST, scores)
        self.keep(anchors, 0, scores, ids, rows)

    def keep(self, anchors, window: int, scores, ids, rows) -> None:
        values, places = best(scores, self.many)
        values = np.concatenate((self.found[anchors, window], values), axis=1)
        names = np.concatenate((self.names[anchors, window], np.stack((ids[places], rows[places]), axis=-1)), axis=1)
        order = np.lexsort((names[..., 1], names[..., 0], -np.maximum(values, LEAST + 1)), axis=1)[:, : self.many]
        self.found[anchors, window] = np.take_along_axis(values, order, axis=1)
        self.names[anchors, window] = np.take_along_axis(names, order[..., None], axis=1)


class Negatives(Positives):
    """The best rows of other labels inside the windows of the anchor's positives; ``limits`` holds the positives' scores."""

    def __init__(self, panel: _Panel, wanted: Wanted):
        self.panel, self.many = panel, wanted.negatives
        score = panel.limits.reshape(len(panel.ids), -1)
        there = score != NO_WINDOW
        known = np.where(there, score, 0)
        self.low = np.where(there, -((-known * wanted.low) // 100), 1)
        self.high = np.where(there, (known * wanted.high) // 100, 0)
        shape = (*score.shape, self.many)
        self.found = np.full(shape, LEAST)
        self.names = np.zeros((*shape, 2), np.int64)

    def reach(self, least, most, labels):
        other = self.panel.labels[:, None] != labels
        any_window = np.zeros(other.shape, bool)
        for k in range(self.low.shape[1]):
            low = np.maximum(self.low[:, k], self.found[:, k, -1])
            meets = (most >= low[:, None]) & (least <= self.high[:, k, None])
            any_window |= meets & (self.low[:, k] <= self.high[:, k])[:, None]
        return other & any_window

    def take(self, anchors, scores, ids, rows):
        for k in range(self.low.shape[1]):
            low = np.maximum(self.low[anchors, k], self.found[anchors, k, -1])
            fits = (scores >= low[:, None]) & (scores <= self.high[anchors, k, None])
            hit = np.flatnonzero(fits.any(axis=1))
            if len(hit):
                self.keep(anchors[hit], k, np.where(fits[hit], scores[hit], LEAST), ids, rows)


def _choose(search: type[Positives], wanted: Wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, *panel, zones in zip(*[c.to_pylist() for c in batch.columns]):
                panel = _Panel(*panel)
                boxes = [_unpacked(z["zone"], 2) for z in zones]
                least, most = bounds(
                    panel.matrix, _stacked([b[:1] for b in boxes]), _stacked([b[1:] for b in boxes])
                )
                reached = search(panel, wanted).reach(least, most, np.array([z["label"] for z in zones], np.int64))
                for k in np.flatnonzero(reached.any(axis=0)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([zones[k]["block"]]), pa.array([float(most[reached[:, k], k].max())])],
                        ["panel", "block", "bound"],
                    )

    return run


def _search(search: type[Positives], wanted: Wanted):
    names = ["panel", "at", "k", "anchor_id", "id", "row", "score"]

    def rows_of(name: int, state: Positives) -> pa.RecordBatch:
        at, k, nth = np.nonzero(state.found > LEAST)
        found = state.names[at, k, nth]
        columns = [np.full(len(at), name), at, k, state.panel.ids[at], found[:, 0], found[:, 1], state.found[at, k, nth]]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            for panel, part, kind, _, *payload in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    if state is not None:
                        yield rows_of(name, state)
                    name, state = panel, search(_Panel(*payload), wanted)
                    continue
                ids, rows, label, matrix, _ = payload
                ids, rows = np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64)
                points = _unpacked(matrix, len(ids))
                least, most = bounds(state.panel.matrix, points.min(axis=0)[None], points.max(axis=0)[None])
                anchors = np.flatnonzero(state.reach(least, most, np.frombuffer(label, np.int64))[:, 0])
                if len(anchors):
                    state.take(anchors, inner_products(state.panel.matrix[anchors], points), ids, rows)
        if state is not None:
            yield rows_of(name, state)

    return run


def _label_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = [np.int64(x).tobytes() for x in batch.column("labels").to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("labels"), "labels", pa.array(labels, pa.binary()))


def _read(panels: DataFrame, blocks: DataFrame, search: type[Positives], wanted: Wanted, sizes: Sizes) -> tuple[DataFrame, DataFrame]:
    """(what each panel found, slice by slice; chosen (panel, block) pairs)."""
    spark = blocks.sparkSession
    n_blocks = blocks.count()
    pages, slices = max(1, -(-n_blocks // sizes.page_zones)), max(1, -(-n_blocks // sizes.slice_blocks))
    zones = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(pages)).cast("int").alias("page")).agg(
        F.collect_list(F.struct("block", "label", "zone")).alias("zones")  # about page_zones of them
    )
    asked = panels.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    dealt = asked.join(zones, "page").select("panel", "ids", "rows", "labels", "matrix", "limits", "zones")
    pairs = stage(
        dealt.repartition(shuffle_width(spark)).mapInArrow(_choose(search, wanted), "panel long, block long, bound double")
        .withColumn("part", F.pmod(F.xxhash64(F.lit(1), "block"), F.lit(slices)).cast("int")), "pairs",
    )
    payload = ["ids", "rows", "labels", "matrix", "limits"]
    heads = pairs.select("panel", "part").distinct().join(panels, "panel").select(
        "panel", "part", F.lit(0).alias("kind"), F.lit(0.0).alias("bound"), *payload
    )
    bodies = pairs.join(
        blocks.select("block", "ids", "rows", F.col("label").alias("labels"), "matrix"), "block"
    ).select("panel", "part", F.lit(1).alias("kind"), "bound", "ids", "rows", "labels", "matrix", F.lit(None).cast("binary").alias("limits"))
    head_schema = "panel long, part int, kind int, bound double, ids binary, rows binary, labels binary, matrix binary, limits binary"
    stream = heads.union(bodies.mapInArrow(_label_bytes, head_schema)).repartition(
        shuffle_width(spark), "panel", "part"
    ).sortWithinPartitions("panel", "part", "kind", F.col("bound").desc())
    found = stream.mapInArrow(
        _search(search, wanted), "panel long, at long, k long, anchor_id long, id long, row long, score long"
    )
    return found, pairs


def _ranked(found: DataFrame, many: int) -> DataFrame:
    order = Window.partitionBy("panel", "at", "k").orderBy(F.col("score").desc(), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= many)


def _with_scores(positives: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, ids, rows, labels, matrix, scores in zip(*[c.to_pylist() for c in batch.columns]):
                limits = np.full((len(ids) // 8, positives), NO_WINDOW)
                for s in scores:
                    limits[s["at"], s["rank"] - 1] = s["score"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name])] + [pa.array([v], pa.binary()) for v in (ids, rows, labels, matrix, limits.tobytes())],
                    _PANEL_NAMES,
                )

    return run


def hard_negatives(
    rows: DataFrame, anchor: Column, id_column: str = "vec_id", vector_column: str = "embedding", label: Column | str = "label",
    scale: float = 256.0, wanted: Wanted = Wanted(), sizes: Sizes = Sizes(), counts: dict | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for all rows flagged by ``anchor``.

    Scores are inner products of floor(scale * x). A positive is one of the anchor's ``wanted.positives`` best other rows
    of its label, a negative one of the ``wanted.negatives`` best rows of another label with a score between ``low`` and
    ``high`` percent of the positive's; ties go by id. Rows without id, label or vector, or with a null or non-finite
    component, take no part. Repeated rows are rows of their own, for positives of each other too. Shorter vectors are
    padded with zeros; components count up to 2^62 and scores up to 9.2e16. No usable row or no anchor gives no row.
    ``counts`` receives the numbers of blocks, panels and chosen pairs.
    """
    label = F.col(label) if isinstance(label, str) else label
    blocks = blocks_of(usable_rows(rows, id_column, vector_column, label, anchor), scale, sizes, wanted.positives)
    panels = panels_of(blocks, sizes)
    near, chosen = _read(panels, blocks, Positives, wanted, sizes)
    positives = stage(_ranked(near, wanted.positives), "positives")
    limits = positives.groupBy("panel").agg(F.collect_list(F.struct("at", "rank", "score")).alias("scores"))
    asking = stage(panels.drop("limits").join(limits, "panel").mapInArrow(_with_scores(wanted.positives), _PANEL), "panels")
    far, asked = _read(asking, blocks, Negatives, wanted, sizes)
    if counts is not None:
        counts |= {"blocks": blocks.count(), "panels": panels.count(), "positive_pairs": chosen.count(), "negative_pairs": asked.count()}
    windows = positives.select(
        "panel", "at", (F.col("rank") - 1).cast("long").alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return _ranked(far, wanted.negatives).join(windows, ["panel", "at", "k"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
