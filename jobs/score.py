"""Job: stored or JSON requests and fitted artifacts -> decisions and quarantined requests (Parquet)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from parceltide.plans.training import score_batch, score_bodies
from parceltide.session import apply_skew_settings, size_shuffles
from parceltide.sinks import load_artifacts


def parse_args(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--requests", required=True)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--json", action="store_true", help="the requests are JSON lines, each judged on its own")
    known, _ = parser.parse_known_args(argv)
    return known


def run(spark: SparkSession, requests: str, artifacts: str, output: str, json: bool = False, **bounds) -> None:
    """Every request ends in ``decisions`` or, with its reasons, in ``quarantine``."""
    size_shuffles(spark, requests)
    model, winner, threshold = load_artifacts(spark, artifacts)
    if json:
        bodies = spark.read.text(requests).withColumnRenamed("value", "body")
        decided, held = score_bodies(model, bodies, threshold, winner, **bounds)
    else:
        decided, held = score_batch(model, spark.read.parquet(requests), threshold, winner, **bounds)
    decided.write.mode("errorifexists").parquet(f"{output}/decisions")
    held.write.mode("errorifexists").parquet(f"{output}/quarantine")


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = apply_skew_settings(SparkSession.builder.appName("order-scores").getOrCreate())
    try:
        run(spark, args.requests, args.artifacts, args.output, args.json)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
