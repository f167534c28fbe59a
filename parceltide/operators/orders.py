"""Eligible orders: cohort filter, lateness target and purchase-time features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C


def is_eligible() -> Column:
    """Delivered, with both dates known."""
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return (F.col("order_status") == C.DELIVERED) & delivered.isNotNull() & estimated.isNotNull()


def delivered_cohort(orders: DataFrame) -> DataFrame:
    """Eligible orders with the calendar-date target."""
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return orders.where(is_eligible()).select(
        "order_id", "customer_id", "order_purchase_timestamp", "order_approved_at",
        F.to_date(estimated).alias("estimated_date"),
        (F.to_date(delivered) > F.to_date(estimated)).cast("int").alias(C.TARGET),
    )


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Wall-clock seconds between zone-free timestamps.

    Subtracting keeps the session zone out of it; ``timestampdiff`` would convert
    both sides to that zone and lose or gain an hour at a clock change.
    """
    gap = end - start
    part = lambda unit, size: F.extract(F.lit(unit), gap).cast("double") * F.lit(float(size))
    return part("DAY", 86400) + part("HOUR", 3600) + part("MINUTE", 60) + part("SECOND", 1)


def purchase_features() -> list[Column]:
    """The eight order-time features of a cohort row, Monday being day 0."""
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    seconds = elapsed_seconds(bought, approved)
    return [
        F.year(bought).alias("purchase_year"),
        F.month(bought).alias("purchase_month"),
        F.weekday(bought).alias("purchase_day_of_week"),
        F.hour(bought).alias("purchase_hour"),
        (seconds / F.lit(3600.0)).alias("approval_delay_hours"),
        approved.isNull().alias("approval_timestamp_missing"),
        F.datediff("estimated_date", F.to_date(bought)).alias("promised_delivery_window_days"),
    ]


def eligible_orders(orders: DataFrame) -> DataFrame:
    return delivered_cohort(orders).select(
        "order_id", "customer_id", "order_purchase_timestamp", *purchase_features(), C.TARGET
    )


def with_items_only(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders that have at least one item row.

    The item keys are made distinct first: a semi-join cannot split its right side.
    """
    return orders.join(items.select("order_id").distinct(), "order_id", "left_semi")
