"""Summaries of the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parceltide import contracts as C
from parceltide.operators.selection import quantiles

DISTANCE = "seller_customer_distance_km_mean"
QUANTILES = {"minimum": 0.0, "median": 0.5, "p95": 0.95, "p99": 0.99, "maximum": 1.0}


def feature_summary(features: DataFrame) -> DataFrame:
    """Rows, distinct orders, class counts and orders without payment, in one row."""
    return features.agg(
        F.count("*").alias("rows"),
        F.count_distinct(C.ORDER_KEY).alias("unique_order_id"),
        F.count_if(F.col(C.TARGET) == 1).alias("late"),
        F.count_if(F.col(C.TARGET) == 0).alias("on_time"),
        F.count_if("payment_data_missing").alias("eligible_orders_without_payment"),
    )


def flag_counts(features: DataFrame) -> DataFrame:
    """Late, on-time and invalid targets; a NULL target is invalid."""
    flag = F.col(C.TARGET)
    return features.agg(
        F.count_if(flag == 1).alias("late_count"),
        F.count_if(flag == 0).alias("on_time_count"),
        F.count_if(flag.isNull() | ~flag.isin(0, 1)).alias("invalid_delay_flag_count"),
    )


def missing_by_column(features: DataFrame) -> DataFrame:
    """(column_name, missing_values) for every feature column, from one aggregate."""
    counts = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in features.columns])
    return counts.unpivot([], list(features.columns), "column_name", "missing_values")


def quality_counts(features: DataFrame) -> DataFrame:
    """Suspicious delays and windows, and orders without coordinates or distance."""
    return features.agg(
        F.count_if(F.col("approval_delay_hours") < 0).alias("negative_approval_delay_count"),
        F.count_if(F.col("promised_delivery_window_days") < 0).alias("negative_promised_window_count"),
        F.count_if("customer_geolocation_missing").alias("orders_missing_customer_coordinates"),
        F.count_if(F.col(DISTANCE).isNull()).alias("orders_with_no_available_seller_customer_distance"),
    )


def distance_distribution(features: DataFrame) -> DataFrame:
    """Exact minimum, median, p95, p99 and maximum of the mean distance."""
    return quantiles(features.select(DISTANCE), DISTANCE, QUANTILES)


def quality_summary(features: DataFrame, geo_counts: DataFrame) -> DataFrame:
    """One row joining the feature counts with the separate geolocation counts."""
    report = quality_counts(features)
    one_row = F.struct(*geo_counts.columns).alias("geo")
    return report.withColumn("geo", geo_counts.select(one_row).scalar()).select(
        "geo.*", *[c for c in report.columns]
    )


def sample_rows(features: DataFrame, rows: int = 5) -> DataFrame:
    """First rows by order key, on the inspection columns."""
    return features.select(
        C.ORDER_KEY, C.PURCHASE_TIME, "customer_state", "item_price_total", "payment_data_missing",
        "primary_payment_type", DISTANCE, C.TARGET,
    ).orderBy(C.ORDER_KEY).limit(rows)
