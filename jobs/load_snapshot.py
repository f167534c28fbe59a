"""Job: feature files -> snapshot table, with contract and row reconciliation."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from parceltide import contracts as C
from parceltide.operators.reconcile import reconcile_rows, schema_diff
from parceltide.operators.validate import ContractViolation
from parceltide.session import apply_skew_settings, size_shuffles
from parceltide.snapshots import create_snapshot, merge_snapshot
from parceltide.sources.tables import expected_inventory, read_external, schema_inventory


def parse_args(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--features", required=True)
    parser.add_argument("--table", required=True)
    parser.add_argument("--location", required=True)
    known, _ = parser.parse_known_args(argv)
    return known


def run(spark: SparkSession, features: str, table: str, location: str) -> DataFrame:
    """Load, merge the new orders, and compare both ways; returns the differences.

    A differing column fails before anything is merged. Orders that the snapshot
    already holds stay as they were, so changed rows show up as differences.
    """
    size_shuffles(spark, features)
    loaded = read_external(spark, features)
    moved = schema_diff(expected_inventory(spark), schema_inventory(loaded)).collect()
    if moved:
        raise ContractViolation(f"columns differ from the contract: {[tuple(r) for r in moved]}")
    create_snapshot(spark, table, location)
    merge_snapshot(loaded, table)
    return reconcile_rows(loaded, spark.table(table), C.FEATURE_ROW)


def main(argv=None) -> None:
    args = parse_args(argv)
    spark = apply_skew_settings(SparkSession.builder.appName("order-snapshot").getOrCreate())
    try:
        print(run(spark, args.features, args.table, args.location).first().asDict())
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
