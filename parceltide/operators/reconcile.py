"""Comparisons between two versions of a table, and the insert-only merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

RTOL = ATOL = 1e-9


def reconcile_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct-row and multiset differences in both directions, in one shuffle.

    Rows are tagged by side and grouped on every compared column, which treats
    NULLs as equal. A row copied very often is combined before the shuffle.
    """
    columns = list(columns)
    tagged = left.select(*columns, F.lit(1).alias("in_left"), F.lit(0).alias("in_right")).unionByName(
        right.select(*columns, F.lit(0).alias("in_left"), F.lit(1).alias("in_right"))
    )
    rows = tagged.groupBy(*columns).agg(F.sum("in_left").alias("l"), F.sum("in_right").alias("r"))
    surplus = lambda a, b: F.coalesce(F.sum(F.greatest(F.col(a) - F.col(b), F.lit(0))), F.lit(0))
    return rows.agg(
        F.count_if((F.col("l") > 0) & (F.col("r") == 0)).alias("left_rows_missing_from_right"),
        F.count_if((F.col("r") > 0) & (F.col("l") == 0)).alias("right_rows_missing_from_left"),
        surplus("l", "r").alias("left_surplus_copies"),
        surplus("r", "l").alias("right_surplus_copies"),
    )


def _differs(low: Column, high: Column, gap: Column, tolerant: bool) -> Column:
    """Whether the two values of a key differ; ``low`` is the left one."""
    if not tolerant:
        return ~low.eqNullSafe(high)
    apart = gap > F.lit(ATOL) + F.lit(RTOL) * F.abs(high)
    return F.when(low.isNotNull() & high.isNotNull(), apart & ~low.eqNullSafe(high)).otherwise(
        low.isNull() != high.isNull()
    )


_PRINT_BITS = 36  # of a value's hash; sums of 134 million copies of a key still fit


def _signed_print(column: Column) -> Column:
    """Hash of a value, counted positively on the left and negatively on the right: equal multisets add up to 0."""
    return F.col("sign") * F.xxhash64(column).bitwiseAND((1 << _PRINT_BITS) - 1)


def reconcile_keyed(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per column: mismatches among matched keys and, for floats, the largest gap.

    Two extra rows count keys found on one side only. NULL placement is exact. Both sides are tagged and grouped by
    key, so that repeated keys combine before the shuffle. A key with one row on each side is compared value by value,
    floats within a tolerance. The copies of a repeated key are compared as multisets, column by column and exactly,
    by sums of value hashes that do not depend on their order. A NULL key is one key.
    """
    compared = [c for c in columns if c != key]
    floats = {f.name for f in left.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    row = lambda frame, sign: frame.select(
        F.col(key).alias("key"), F.lit(sign).cast("long").alias("sign"), F.struct(*compared).alias("row")
    )
    on_left = F.col("sign") > 0
    keys = row(left, 1).unionByName(row(right, -1)).groupBy("key").agg(
        F.max(F.when(on_left, F.col("row"))).alias("l"), F.max(F.when(~on_left, F.col("row"))).alias("r"),
        F.count_if(on_left).alias("n_l"), F.count_if(~on_left).alias("n_r"),
        *[F.sum(_signed_print(F.struct(F.col("row")[c].isNull(), F.col("row")[c]))).alias(f"print{i}") for i, c in enumerate(compared)],
    )
    both = (F.col("n_l") > 0) & (F.col("n_r") > 0)
    single = (F.col("n_l") == 1) & (F.col("n_r") == 1)
    aggregates = [F.count_if(F.col("n_r") == 0).alias("only_left"), F.count_if(F.col("n_l") == 0).alias("only_right")]
    rows = [
        F.struct(F.lit(label).alias("column_name"), F.col(c).alias("mismatches"),
                 F.lit(None).cast("double").alias("max_abs_difference"))
        for label, c in (("<only in left>", "only_left"), ("<only in right>", "only_right"))
    ]
    for i, c in enumerate(compared):
        x, y = F.col("l")[c], F.col("r")[c]
        gap = F.abs(x - y) if c in floats else F.lit(None).cast("double")
        differs = F.when(single, _differs(x, y, gap, c in floats)).otherwise(both & (F.col(f"print{i}") != 0))
        aggregates.append(F.count_if(differs).alias(f"bad{i}"))
        largest = F.lit(None).cast("double")
        if c in floats:
            aggregates.append(F.max(F.when(single, gap)).alias(f"gap{i}"))
            largest = F.col(f"gap{i}")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"bad{i}").alias("mismatches"), largest.alias("max_abs_difference"),
        ))
    return keys.agg(*aggregates).select(F.inline(F.array(*rows)))


def schema_diff(
    expected: DataFrame, actual: DataFrame, columns: Sequence[str] = ("ordinal_position", "column_name")
) -> DataFrame:
    """Column descriptions on one side only, with the direction, ordered."""
    e, a = expected.select(*columns), actual.select(*columns)
    directed = lambda label, diff: diff.select(F.lit(label).alias("difference_direction"), *columns)
    return directed("EXPECTED_MINUS_ACTUAL", e.subtract(a)).unionByName(
        directed("ACTUAL_MINUS_EXPECTED", a.subtract(e))
    ).orderBy("difference_direction", "ordinal_position")


def rows_to_insert(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not hold yet."""
    return source.join(target.select(key), key, "left_anti").select(*source.columns)


def insert_only_merge(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Target after the merge: matched rows stay untouched, new keys are appended."""
    return target.unionByName(rows_to_insert(source, target, key).select(*target.columns))
