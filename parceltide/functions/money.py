"""Exact money sums, rounded once.

Amounts are summed as decimals with ten places: the result does not depend on
summation order, ranking ties are true ties, and only a total is rounded to
cents. An overflow raises under ANSI mode.

Where very many rows are summed, an amount is split into two integers, whole units and ten
decimal places: their sums give the same decimal without making one per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact(amount: Column) -> Column:
    return amount.cast("decimal(28,10)")


def rounded(total: Column) -> Column:
    return F.round(total, 2).cast("double")


def split(amount: Column) -> tuple[Column, Column]:
    """``exact`` of a double as two long columns: whole units, rounded down, and the rest in units of 10**-10.

    Below 10**9 an amount that is whole cents shows that as a double; only others become a decimal first.
    """
    cents = F.rint(amount * 100)
    whole_cents = (F.abs(amount) < 1e9) & (cents / 100 == amount)
    units, decimal = F.floor(amount), exact(amount)
    rest = (decimal - F.floor(decimal)).cast("decimal(11,10)") * F.lit(10**10).cast("decimal(11,0)")
    return (
        F.when(whole_cents, units).otherwise(F.floor(decimal).cast("bigint")),
        F.when(whole_cents, (cents.cast("bigint") - units * 100) * 10**8).otherwise(rest.cast("bigint")),
    )


def joined(units: Column, rest: Column) -> Column:
    """The decimal of which sums of ``split`` columns are the parts."""
    return units.cast("decimal(29,10)") + rest.cast("decimal(19,0)") * F.lit("1E-10").cast("decimal(10,10)")
