"""Per-order payment rollup and its defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C
from parceltide.functions import money
from parceltide.operators.items import primary_value


def payment_rollup(payments: DataFrame) -> DataFrame:
    """Row count, distinct types, exact total, largest instalment plan, primary type.

    (order, type) subtotals feed every output, so the payments are read once.
    """
    by_type = payments.groupBy("order_id", "payment_type").agg(
        F.count("*").alias("n"),
        F.sum(money.exact(F.col("payment_value"))).alias("amount"),
        F.max("payment_installments").alias("installments"),
    )
    rank = F.struct(-F.col("amount"), -F.col("n"), F.col("payment_type").alias("key"))
    return by_type.groupBy("order_id").agg(
        F.sum("n").alias("payment_row_count"),
        F.count("payment_type").alias("distinct_payment_type_count"),
        money.rounded(F.sum("amount")).alias("payment_value_total"),
        F.max("installments").alias("max_payment_installments"),
        F.min(F.when(F.col("payment_type").isNotNull(), rank)).getField("key").alias("primary_payment_type"),
    )


def primary_payment_type(payments: DataFrame) -> DataFrame:
    return primary_value(
        payments, "payment_type", "payment_value", label="order_id", output="primary_payment_type"
    )


def payment_features() -> list[Column]:
    """Payment columns after a left join, with the defaults of an order without payment."""
    defaults = {
        "payment_row_count": F.lit(0), "distinct_payment_type_count": F.lit(0),
        "payment_value_total": F.lit(0.0), "max_payment_installments": F.lit(0),
        "primary_payment_type": F.lit(C.MISSING_PAYMENT),
    }
    filled = [
        F.coalesce(F.col(c), value).cast(C.FEATURE_TYPES[c]).alias(c) for c, value in defaults.items()
    ]
    return [*filled, F.col("payment_row_count").isNull().alias("payment_data_missing")]


def payment_profile(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Eligible orders with their payment features; no order is lost."""
    rolled = payment_rollup(payments)
    return orders.join(rolled, "order_id", "left").select(
        *[orders[c] for c in orders.columns], *payment_features()
    )
