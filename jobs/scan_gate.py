"""Job: scan documents and an allowlist -> pass or fail, and the findings that are only reported (Parquet)."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.operators.findings import gate
from parceltide.session import apply_skew_settings, stage
from parceltide.sinks import write_features

ALLOWLIST = "cve string, severity string, package string, version string, source string, rationale string, review_by string"


def parse_args(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--scans", required=True, help="folder of JSON documents, one per image")
    parser.add_argument("--allowlist", required=True, help="JSON array of entries")
    parser.add_argument("--output", required=True)
    parser.add_argument("--as-of", default=None)
    parser.add_argument("--expected-entries", type=int, default=None)
    known, _ = parser.parse_known_args(argv)
    return known


def run(
    spark: SparkSession, scans: str, allowlist: str, output: str, today: str | None = None, expected_entries: int | None = None
) -> DataFrame:
    """Raises on any broken rule or unapproved finding before anything is written; else the findings by severity.

    A finding is unique per image, so the same one in many images is no duplicate.
    """
    documents = spark.read.text(scans, wholetext=True).select(
        F.col("_metadata.file_path").alias("image"), F.col("value").alias("document")
    )
    allowed = stage(spark.read.schema(ALLOWLIST).option("multiLine", True).json(allowlist), "allowlist")
    key = ("image", "cve")
    reported = gate(documents, allowed, today or datetime.date.today().isoformat(), expected_entries, key)
    write_features(reported, output)
    return spark.read.parquet(output).groupBy("severity").agg(F.count("*").alias("findings"))


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = apply_skew_settings(SparkSession.builder.appName("scan-gate").getOrCreate())
    try:
        for row in run(spark, args.scans, args.allowlist, args.output, args.as_of, args.expected_entries).collect():
            print(row.asDict())
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
