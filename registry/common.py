"""Shared inputs of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide import contracts as C
from parceltide.operators.orders import eligible_orders, with_items_only
from parceltide.operators.payments import payment_features, payment_rollup
from parceltide.plans.order_features import order_features
from parceltide.session import prepare, stage
from parceltide.sources.retail_views import read_table, retail_sources  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its check."""

    def keep(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return function

    return keep


def cohort(spark: SparkSession, folder: str) -> DataFrame:
    """Eligible orders that own item rows."""
    src = retail_sources(spark, folder)
    return with_items_only(eligible_orders(src["orders"]), src["items"])


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Cohort with a deterministic score that has ties by design."""
    return cohort(spark, folder).select(
        "order_id", "order_purchase_timestamp", "delay_flag",
        ((F.col("order_id") * 7919 % 1000) / F.lit(1000.0)).alias("risk_score"),
    )


@lru_cache(maxsize=8)
def _stored_features(spark: SparkSession, application: str, folder: str) -> DataFrame:
    return stage(order_features(retail_sources(spark, folder)), "features")


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    """The stored feature table: built once per application and folder.

    Everything downstream of the build (summaries, reconciliation, models)
    reads files, as it would in production.
    """
    return _stored_features(spark, spark.sparkContext.applicationId, folder)


def earlier_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The table as loaded earlier: orders before 1998, first payments only."""
    features = feature_table(spark, folder).where(
        F.col(C.PURCHASE_TIME) < F.lit("1998-01-01").cast("timestamp_ntz")
    )
    payments = retail_sources(spark, folder)["payments"].where(F.col("payment_sequential") == 1)
    paid = [c for c in C.FEATURE_ROW if "payment" in c]
    return features.drop(*paid).join(payment_rollup(payments), "order_id", "left").select(
        *[features[c] for c in features.columns if c not in paid], *payment_features()
    ).select(*C.FEATURE_ROW)


SNAPSHOT_SQL = {
    "snapshot": """
SELECT f.* REPLACE (
    coalesce(p.n, 0)::BIGINT AS payment_row_count, coalesce(p.n, 0)::BIGINT AS distinct_payment_type_count,
    coalesce(p.payment_value, 0.0)::DOUBLE AS payment_value_total,
    coalesce(p.payment_installments, 0)::BIGINT AS max_payment_installments,
    coalesce(p.payment_type, '__missing_payment__') AS primary_payment_type,
    p.n IS NULL AS payment_data_missing)
FROM features f LEFT JOIN (SELECT *, 1 AS n FROM v_payments WHERE payment_sequential = 1) p ON f.order_id = p.order_id
WHERE f.order_purchase_timestamp < TIMESTAMP '1998-01-01'""",
}
