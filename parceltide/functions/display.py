"""Text formats of the risk report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _fixed(value: Column, pattern: str) -> Column:
    """Rounds the exact binary value and ties to even, as printf does; ``format_string`` rounds the shortest decimal text up."""
    return F.call_function("format_number", value, F.lit(pattern))


def percent_text(share: Column) -> Column:
    """``0.12345`` -> ``12.35%``"""
    return F.concat(_fixed(share * 100, "0.00"), F.lit("%"))


def distance_text(km: Column) -> Column:
    """``12.34`` -> ``12.3 km``; a dash when unknown."""
    return F.when(km.isNull(), F.lit("—")).otherwise(F.concat(_fixed(km, "0.0"), F.lit(" km")))
