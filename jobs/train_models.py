"""Job: feature table -> fitted model, comparison and report."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from parceltide.plans.training import compare_candidates, train_baseline
from parceltide.session import apply_skew_settings, size_shuffles
from parceltide.sinks import save_artifacts
from parceltide.sources.tables import load_features


def parse_args(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--features", required=True)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--experiment", choices=("baseline", "v2"), default="baseline")
    known, _ = parser.parse_known_args(argv)
    return known


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = apply_skew_settings(SparkSession.builder.appName("order-models").getOrCreate())
    try:
        experiment = compare_candidates if args.experiment == "v2" else train_baseline
        size_shuffles(spark, args.features)
        outcome = experiment(load_features(spark, args.features))
        save_artifacts(outcome.model, outcome.report, args.artifacts)
        print(outcome.winner, outcome.threshold)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
