"""Exact quantiles by bracketing: counts per bin instead of sorted rows.

A quantile is one or two ranks. Each rank starts with the bracket [least, largest] of its
group; a pass counts the values of the bracket in equal bins, which combine before their
shuffle, and the bin that covers the rank becomes the next bracket. Once a bracket holds few
values, or only one, it is read out. Nothing is ever sorted or moved as a whole, and a group
may hold all rows. Groups that are small to begin with are read out at once.

A quantile of many columns of numbers is bracketed by points instead: each task sums a column up as values with counts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from parceltide.session import batches, stage

READ_OUT = 100_000  # values of a bracket that are gathered in one row
BINS = 1024
POINTS = 1 << 16  # different values whose ranks are exact


def _at(values: Column, rank: Column) -> Column:
    return F.element_at(values, rank.cast("int") + 1)


def _between(low: Column, high: Column, weight: Column) -> Column:
    return low + (high - low) * weight


def _positions(size: Column, probabilities: dict[str, float]) -> list[Column]:
    return [(size - 1) * F.lit(float(p)) for p in probabilities.values()]


def _read_out(rows: DataFrame, value: str, probabilities: dict[str, float], within: list[str]) -> DataFrame:
    """Quantiles of groups that fit into one row each."""
    gathered = rows.groupBy(*within).agg(F.sort_array(F.collect_list(value)).alias("_all"))
    size = F.size("_all")
    picks = [
        _between(_at(F.col("_all"), F.floor(p)), _at(F.col("_all"), F.ceil(p)), p - F.floor(p)).alias(name)
        for name, p in zip(probabilities, _positions(size, probabilities))
    ]
    return gathered.select(*within, *picks)


def _quarter(value: Column) -> Column:
    """A quarter of the value, infinities and NaN as the largest number: the width of any bracket is finite."""
    limit = F.lit(sys.float_info.max)
    return F.greatest(F.least(F.when(F.isnan(value), limit).otherwise(value), limit), -limit) / 4


def _bin(value: Column, low: Column, high: Column) -> Column:
    """Number of the equal part of [low, high] that holds the value: monotonous, 0 at low, BINS - 1 at high.

    Infinities and NaN, which sort last, have bins of their own outside, so a bracket of two values always parts.
    """
    width = F.nullif(_quarter(high) - _quarter(low), F.lit(0.0))
    part = F.coalesce(F.floor((_quarter(value) - _quarter(low)) / width * BINS), F.lit(0))
    inside = F.when(value == high, BINS - 1).otherwise(F.least(F.greatest(part, F.lit(0)), F.lit(BINS - 1)))
    infinity = F.lit(float("inf"))
    return F.when(F.isnan(value), BINS + 1).when(value == infinity, BINS).when(value == -infinity, -1).otherwise(inside).cast("int")


def _met(rows: DataFrame, ranks: DataFrame, value: str, within: list[str]) -> DataFrame:
    """Each value beside the ranks whose bracket holds it; the ranks are few and broadcast below the planner's limit."""
    return rows.join(ranks, within).where((F.col(value) >= F.col("low")) & (F.col(value) <= F.col("high")))


def _refined(rows: DataFrame, ranks: DataFrame, value: str, within: list[str]) -> DataFrame:
    """The next bracket of every rank: (within, rank, low, high, below, inside)."""
    counted = (
        _met(rows, ranks, value, within)
        .groupBy(*within, "rank", "below", _bin(F.col(value), F.col("low"), F.col("high")).alias("_bin"))
        .agg(F.count("*").alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    )
    order = Window.partitionBy(*within, "rank").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # at most BINS + 3 rows
    before = F.col("below") + F.coalesce(F.sum("_n").over(order), F.lit(0))
    return counted.withColumn("_before", before).where(
        (F.col("_before") <= F.col("rank")) & (F.col("rank") < F.col("_before") + F.col("_n"))
    ).select(
        *within, "rank", F.col("_low").alias("low"), F.col("_high").alias("high"), F.col("_before").alias("below"),
        F.col("_n").alias("inside"),
    )


def quantiles(
    frame: DataFrame, value: str, probabilities: dict[str, float], within: Sequence[str] = (), read_out: int = READ_OUT
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, one column per entry of ``probabilities``; NULLs are skipped.

    Groups without a value are left out; an ungrouped frame without any gives a row of NULLs. ``within`` columns must
    not be NULL. The frame is read once per pass. Groups and brackets above ``read_out`` values are counted, smaller ones gathered: the result is the same.
    """
    within = list(within)
    if not within:  # one group, named by a constant
        return _quantiles(frame.select(F.lit(0).alias("_all"), value), value, probabilities, ["_all"], read_out).agg(
            *[F.max(name).alias(name) for name in probabilities]
        )
    return _quantiles(frame, value, probabilities, within, read_out)


def _quantiles(frame: DataFrame, value: str, probabilities: dict[str, float], within: list[str], read_out: int) -> DataFrame:
    keys = [f"_g{i}" for i in range(len(within))]
    rows = frame.where(F.col(value).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(within, keys)], F.col(value).cast("double").alias("_v")
    )
    sizes = stage(rows.groupBy(*keys).agg(
        F.count("*").alias("_size"), F.min("_v").alias("low"), F.max("_v").alias("high"),
    ), "sizes")
    large = sizes.where(F.col("_size") > read_out)
    names = [F.col(k).alias(c) for k, c in zip(keys, within)]
    if large.limit(1).count() == 0:
        return _read_out(rows, "_v", probabilities, keys).select(*names, *probabilities)
    small = _read_out(rows.join(large.select(*keys), keys, "left_anti"), "_v", probabilities, keys)
    return small.unionByName(_selected(rows, large, "_v", probabilities, keys, read_out)).select(*names, *probabilities)


def _selected(
    rows: DataFrame, large: DataFrame, value: str, probabilities: dict[str, float], within: list[str], read_out: int
) -> DataFrame:
    positions = _positions(F.col("_size"), probabilities)
    both = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in positions])))
    ranks = stage(large.select(
        *within, F.explode(both).alias("rank"), "low", "high", F.lit(0).cast("long").alias("below"), F.col("_size").alias("inside")
    ), "ranks")
    settled = F.col("low").eqNullSafe(F.col("high"))
    wide = ~settled & (F.col("inside") > read_out)
    while ranks.where(wide).limit(1).count():
        ranks = stage(_refined(rows, ranks.where(wide), value, within).unionByName(ranks.where(~wide)), "ranks")
    known = ranks.where(settled).select(*within, "rank", F.col("low").alias("_at"))
    gathered = _met(rows, ranks.where(~settled), value, within).groupBy(*within, "rank", "below").agg(
        F.sort_array(F.collect_list(value)).alias("_few")
    ).select(*within, "rank", _at(F.col("_few"), F.col("rank") - F.col("below")).alias("_at"))
    values = known.unionByName(gathered).groupBy(*within).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "_at"))).alias("_ranks")  # two per quantile
    )
    picks = [
        _between(F.col("_ranks")[F.floor(p)], F.col("_ranks")[F.ceil(p)], p - F.floor(p)).alias(name)
        for name, p in zip(probabilities, positions)
    ]
    return large.join(values, within).select(*within, *picks)


# -- columns of numbers ------------------------------------------------------

class Points:
    """Values with their counts; beyond ``POINTS`` different ones, values at even ranks stand for those before them.

    The values up to a point are at least as many as the counts say, and at most ``error`` more.
    """

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.error = 0.0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((values, counts))
        if sum(len(v) for v, _ in self.held) > 4 * POINTS:
            self.held = [self.merged()]

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        values, counts = (np.concatenate(part) for part in zip(*self.held))
        values, at = np.unique(values, return_inverse=True)
        counts = np.bincount(at, counts)
        if len(values) > POINTS:
            ends = np.cumsum(counts)
            ranks = np.minimum(np.ceil(np.arange(1, POINTS) * (ends[-1] / (POINTS - 1))), ends[-1])
            kept = np.unique(np.append(0, np.searchsorted(ends, ranks)))
            values, counts = values[kept], np.diff(ends[kept], prepend=0.0)
            self.error += counts.max()
        return values, counts


_STATE = "pos long, below double, nans double, error double, values array<double>, counts array<double>"


def _inside(columns: int, brackets: dict[int, tuple[float | None, float | None]]):
    """Per wanted column of a task: values up to its bracket, NaN, and the points of (low, high]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, below, nans = ([make() for _ in range(columns)] for make in (Points, float, float))
        some, count = [], 0

        def take() -> None:
            table = pa.Table.from_batches(some)
            for pos, (low, high) in brackets.items():
                values = table.column(pos).drop_null().to_numpy()
                real = values[~np.isnan(values)]
                nans[pos] += len(values) - len(real)
                if low is not None:
                    inside = real[real > low]
                    below[pos] += len(real) - len(inside)
                    real = inside
                if high is not None:
                    real = real[real <= high]
                if len(real):
                    points[pos].add(*np.unique(real, return_counts=True))
            some.clear()

        for batch in batches:
            some.append(batch)
            count += batch.num_rows
            if count >= POINTS:
                take()
                count = 0
        if some:
            take()
        for pos in brackets:
            values, counts = points[pos].merged() if points[pos].held else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (pos, below[pos], nans[pos], points[pos].error)] + [pa.array([v.astype(float)]) for v in (values, counts)],
                ["pos", "below", "nans", "error", "values", "counts"],
            )

    return run


def _narrowed(probability: float, brackets: dict[int, tuple[float | None, float | None]], sizes: dict[int, float]):
    """Per column its size, and the two values around the quantile or else the next bracket of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[list, Points]] = {}
        for batch in batches:
            for k, row in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                sums, points = known.setdefault(row[0], ([0.0, 0.0], Points()))
                sums[0], sums[1], points.error = sums[0] + row[1], sums[1] + row[2], points.error + row[3]
                values, counts = (batch.column(c)[k].values.to_numpy() for c in (4, 5))
                if len(values):
                    points.add(values, counts)
        for pos, ((below, nans), points) in known.items():
            values, counts = points.merged() if points.held else (np.zeros(0), np.zeros(0))
            ends = below + np.cumsum(counts)
            real = sizes.get(pos, ends[-1] if len(ends) else 0.0)
            place = (real + nans - 1) * probability
            first, last = np.floor(place) + 1, np.ceil(place) + 1  # how many values there are up to each
            if real + nans == 0:
                continue
            if points.error == 0:
                low, high = (float(values[np.searchsorted(ends, r)]) if r <= real else float("nan") for r in (first, last))
            else:
                before = int(np.searchsorted(ends + points.error, first)) - 1
                low = float(values[before]) if before >= 0 else brackets[pos][0]
                high = float(values[np.searchsorted(ends, last)]) if last <= real else None
            yield pa.RecordBatch.from_arrays(
                [pa.array([pos]), pa.array([real]), pa.array([float(place)]), pa.array([points.error == 0]), pa.array([low], pa.float64()), pa.array([high], pa.float64())],
                ["pos", "real", "place", "exact", "low", "high"],
            )

    return run


def column_quantile(frame: DataFrame, columns: Sequence[str], probability: float) -> dict[str, float]:
    """The exact, linearly interpolated quantile of every column of doubles; NULLs are skipped, NaN is the largest.

    Columns without a value are left out. The frame is read once per pass, twice for columns of very many different values.
    """
    spark = frame.sparkSession
    columns, out = list(columns), {}
    brackets: dict[int, tuple[float | None, float | None]] = dict.fromkeys(range(len(columns)), (None, None))
    sizes: dict[int, float] = {}
    while brackets:
        with batches(spark, 10000, 4 << 20):
            found = frame.select(*columns).mapInArrow(_inside(len(columns), brackets), _STATE).repartition(
                min(len(columns), spark.sparkContext.defaultParallelism), "pos"
            ).mapInArrow(
                _narrowed(probability, brackets, sizes), "pos long, real double, place double, exact boolean, low double, high double"
            ).collect()  # one row per column
        brackets = {r["pos"]: (r["low"], r["high"]) for r in found if not r["exact"]}
        sizes = {r["pos"]: r["real"] for r in found}
        for r in found:
            if r["exact"]:
                out[columns[r["pos"]]] = r["low"] + (r["high"] - r["low"]) * (r["place"] - float(np.floor(r["place"])))
    return out
