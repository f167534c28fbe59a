"""Strict text-to-type expressions. None of them raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The texts a CSV reader treats as a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
_DIGITS = r"^\s*[+-]?\d+\s*\z"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity))\s*\z"


def text_or_null(column: Column) -> Column:
    return F.when(~column.isin(*MISSING_TOKENS), column)


def timestamp_or_null(column: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as a zone-free timestamp, else NULL."""
    return F.when(column.rlike(_TIMESTAMP), column).try_cast("timestamp_ntz")


def double_or_null(column: Column) -> Column:
    return F.when(column.rlike(_NUMBER), F.trim(column)).try_cast("double")


def long_or_null(column: Column) -> Column:
    """Whole numbers, also when written ``2.0``; NULL for anything else.

    Plain digits are cast directly, so they keep full precision, whatever their
    length; beyond 64 bits they are NULL.
    """
    number = double_or_null(column)
    whole = F.when(number % 1 == 0, number)
    return F.when(column.rlike(_DIGITS), F.trim(column).try_cast("bigint")).otherwise(whole.try_cast("bigint"))


def is_unparseable(raw: Column, parsed: Column) -> Column:
    return raw.isNotNull() & parsed.isNull()


def is_finite(column: Column) -> Column:
    value = column.cast("double")
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
