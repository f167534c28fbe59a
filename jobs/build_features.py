"""Job: CSV sources -> validated feature table (Parquet, fails if it exists)."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.contracts import AUDITED_METRICS
from parceltide.operators.geography import geo_quality
from parceltide.operators.quality import distance_distribution, feature_summary, missing_by_column, quality_summary
from parceltide.operators.validate import check_known_metrics, enforce, feature_violations
from parceltide.plans.ingest import ingest
from parceltide.plans.order_features import build_order_features
from parceltide.session import apply_skew_settings, size_shuffles, stage
from parceltide.sinks import replace_features, write_features, write_report


def parse_args(argv=None) -> argparse.Namespace:
    """Platforms inject their own arguments; those are ignored."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source-root", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--expect-audited-metrics", action="store_true")
    parser.add_argument("--replace", action="store_true", help="write in chronological order over earlier output")
    known, _ = parser.parse_known_args(argv)
    return known


def run(
    spark: SparkSession, source_root: str, output: str, expected: dict[str, int] | None = None, replace: bool = False
):
    """Build, check the staged table, publish it and its quality report; returns its one-row summary.

    A failing check leaves no output behind.
    """
    size_shuffles(spark, source_root)
    sources = ingest(spark, source_root)
    built = stage(build_order_features(sources), "features")
    enforce(feature_violations(built))
    summary = feature_summary(built)
    if expected:
        check_known_metrics(summary, expected)
    (replace_features if replace else write_features)(built, output)
    write_report(quality_report(built, sources), f"{output.rstrip('/')}_quality")
    return summary


def quality_report(features: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """One row: the quality summary, missing values by column and the distance distribution."""
    gaps = missing_by_column(features)
    spread = distance_distribution(features)
    return quality_summary(features, geo_quality(sources["geolocation"])).select(
        "*",
        gaps.agg(F.collect_list(F.struct(*gaps.columns))).scalar().alias("missing_values"),  # one row per column
        spread.select(F.struct(*spread.columns)).scalar().alias("distance_distribution"),
    )


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = apply_skew_settings(SparkSession.builder.appName("order-features").getOrCreate())
    try:
        expected = AUDITED_METRICS if args.expect_audited_metrics else None
        print(run(spark, args.source_root, args.output, expected, args.replace).first().asDict())
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
