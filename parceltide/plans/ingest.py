"""CSV text to typed, row-checked, stored sources with one pass over each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.functions.parsing import is_unparseable
from parceltide.operators.validate import count_violations, enforce, parse_rules, union_all, value_rules
from parceltide.session import stage
from parceltide.sources.csv_files import check_headers, normalise_missing, read_raw, typed_columns


class IngestedSources(dict):
    """Stored sources whose row rules were checked."""


def is_ingested(sources: dict[str, DataFrame]) -> bool:
    return isinstance(sources, IngestedSources)


def _typed_with_flags(name: str, text: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Typed columns plus one flag per typed column: present but unparseable.

    Typed values are computed once, beside their text, and the flag compares
    the two. Flags are almost constant, so they take next to no space on disk.
    """
    raw = {c: f"{c}__text" for _, c, _ in parse_rules(name)}
    flags = {c: f"{c}__unparseable" for c in raw}
    both = text.select(*typed_columns(name, text.columns), *[F.col(c).alias(t) for c, t in raw.items()])
    return both.select(
        *text.columns, *[is_unparseable(F.col(raw[c]), F.col(c)).alias(flag) for c, flag in flags.items()]
    ), flags


def ingest(spark: SparkSession, root: str) -> IngestedSources:
    """Read, normalise, type and store the eight sources, then check their rows.

    The text is parsed once; the checks aggregate stored columns. A failed or
    repeated task cannot distort the counts, since they are taken from the
    committed files.
    """
    check_headers(spark, root)
    stored, checks = IngestedSources(), []
    for name, text in normalise_missing(read_raw(spark, root)).items():
        typed, flags = _typed_with_flags(name, text)
        table = stage(typed, name)
        rules = [(rule, c, F.col(flags[c])) for rule, c, _ in parse_rules(name)] + value_rules(name)
        checks.append(count_violations(name, table, rules))
        stored[name] = table.select(*text.columns)
    enforce(union_all(checks))
    return stored
