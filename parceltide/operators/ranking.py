"""Global order at scale: running totals and ranks.

A window without partition columns, or over one hot key, sorts everything in
one task. Here rows are range-partitioned on the full sort key and written
once with their slice number. A slice holds about 1/N of the rows whatever the
group sizes are, as long as sort keys are mostly distinct; callers aggregate
equal keys first. Running totals are then slice-local sums plus the carry of
earlier slices, which is a table of one row per (group, slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from parceltide.session import shuffle_width, stage

_SLICE = "_slice"


def running_totals(
    frame: DataFrame, order_by: Sequence[Column], totals: dict[str, str], within: Sequence[str] = ()
) -> DataFrame:
    """Add inclusive running sums: ``totals`` maps output name -> summed column.

    ``order_by`` must be a total order inside each ``within`` group, and
    ``within`` columns must not be NULL.
    """
    within = list(within)
    sort_key = [F.col(c) for c in within] + list(order_by)
    sliced = stage(
        frame.repartitionByRange(shuffle_width(frame.sparkSession), *sort_key)
        .withColumn(_SLICE, F.spark_partition_id()),
        "slices",
    )
    local = Window.partitionBy(*within, _SLICE).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*within).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(*within, _SLICE).agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in totals.items()])
        .select(
            *within, _SLICE,
            *[F.coalesce(F.sum(f"_sum_{k}").over(earlier), F.lit(0)).alias(f"_carry_{k}") for k in totals],
        )
    )
    summed = sliced.select("*", *[F.sum(v).over(local).alias(f"_local_{k}") for k, v in totals.items()])
    return summed.join(carried, [*within, _SLICE]).select(
        *frame.columns,
        *[(F.col(f"_local_{k}") + F.col(f"_carry_{k}")).alias(k) for k in totals],
    )


def global_rank(frame: DataFrame, order_by: Sequence[Column], output: str = "rank") -> DataFrame:
    """Dense 1..n position of every row in a total order."""
    return running_totals(frame.withColumn("_one", F.lit(1)), order_by, {output: "_one"}).drop("_one")
