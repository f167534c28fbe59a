"""CSV sources: scan under an exact header contract, then type the used columns."""

from __future__ import annotations

import csv
from itertools import zip_longest

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide import contracts as C
from parceltide.functions import parsing as P
from parceltide.operators.validate import union_all
from parceltide.sources.digests import first_lines
from parceltide.sources.tables import list_files, stream_scheme


def uri_join(root: str, filename: str) -> str:
    return f"{root.rstrip('/')}/{filename}"


def read_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The eight allowed sources as text columns, pruned to the used columns.

    ``enforceSchema=False`` makes the reader compare the header of every file
    with the contract, order included. The parser reads whole rows, not only the
    columns asked for, so that a row with too few or too many fields fails the
    scan and the header check covers every column.
    """
    return {
        name: spark.read.schema(C.csv_schema(name))
        .option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("quote", '"').option("escape", '"')
        .csv(uri_join(root, filename))
        .select(*C.USED_COLUMNS[name])
        for name, filename in C.SOURCE_FILES.items()
    }


def _first_difference(headers: dict[str, tuple[str, ...]]):
    @F.pandas_udf("position int, expected string, found string")
    def compare(sources: pd.Series, lines: pd.Series) -> pd.DataFrame:
        rows = []
        for source, line in zip(sources, lines):
            wanted, given = headers[source], tuple(next(csv.reader([line or ""]), ()))
            both = zip_longest(wanted, given)
            rows.append(next(((k, w, g) for k, (w, g) in enumerate(both, 1) if w != g), (None, None, None)))
        return pd.DataFrame(rows, columns=["position", "expected", "found"])

    return compare


def header_differences(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(source, path, position, expected, found) of every file whose header differs from the contract, at its first difference.

    ``paths`` maps sources to files or folders. The heads of all files are read in tasks, nothing else of them. A source
    without any file with bytes is one row without a path; ``found`` is NULL where the header ends too early.
    """
    listed = union_all([
        list_files(spark, path).select(F.lit(source).alias("source"), "path") for source, path in paths.items()
    ])
    streamed = all(stream_scheme(spark, path) for path in paths.values())
    heads = first_lines(listed) if streamed else union_all([
        spark.read.text(path).select(
            F.lit(source).alias("source"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"),
            F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
        ).where("start = 0").groupBy("source", "path").agg(F.min_by("line", "at").alias("line"))
        for source, path in paths.items()
    ])
    compared = heads.select("source", "path", _first_difference(dict(C.SOURCE_HEADERS))("source", "line").alias("at")).select(
        "source", "path", "at.*"
    )
    wanted = spark.createDataFrame([(s, C.SOURCE_HEADERS[s][0]) for s in paths], "source string, expected string")
    absent = wanted.join(listed.select("source").distinct(), "source", "left_anti").select(
        "source", F.lit(None).cast("string").alias("path"), F.lit(1).alias("position"), "expected",
        F.lit(None).cast("string").alias("found"),
    )
    return compared.where("position IS NOT NULL").unionByName(absent)


def check_headers(spark: SparkSession, root: str) -> None:
    """Fail before the real work when the header of any file differs from the contract, naming file and column."""
    paths = {name: uri_join(root, filename) for name, filename in C.SOURCE_FILES.items()}
    wrong = header_differences(spark, paths).orderBy("source", "path").limit(20).collect()
    if wrong:
        told = "; ".join(f"{r.path or C.SOURCE_FILES[r.source]}: column {r.position} is {r.found!r}, not {r.expected!r}" for r in wrong)
        raise ValueError(f"header differs from the contract: {told}")


def normalise_missing(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Replace the missing-value texts of every column by NULL."""
    return {
        name: frame.select(*[P.text_or_null(F.col(c)).alias(c) for c in frame.columns])
        for name, frame in raw.items()
    }


def typed_columns(source: str, names: list[str]) -> list:
    """Typed projection of a text source; unparseable text becomes NULL."""
    parsers = {
        **dict.fromkeys(C.TIMESTAMP_COLUMNS.get(source, ()), P.timestamp_or_null),
        **dict.fromkeys(C.DECIMAL_NUMBER_COLUMNS.get(source, ()), P.double_or_null),
        **dict.fromkeys(C.WHOLE_NUMBER_COLUMNS.get(source, ()), P.long_or_null),
    }
    return [parsers.get(c, lambda x: x)(F.col(c)).alias(c) for c in names]


def type_sources(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed frames. Run the source rules first: they count what fails to parse."""
    return {name: frame.select(*typed_columns(name, frame.columns)) for name, frame in raw.items()}
