"""Source audits: profile, composition, sequences, domains and lookup coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from parceltide.operators.validate import union_all


def table_profile(frame: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and duplicate-group counts of one table."""
    groups = frame.groupBy(*keys).agg(F.count("*").alias("n"))
    n = F.col("n")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return groups.agg(
        total(n).alias("row_count"),
        F.count("*").alias("distinct_keys"),
        F.count_if(n > 1).alias("duplicate_groups"),
        total(F.when(n > 1, n)).alias("rows_in_duplicate_groups"),
        total(n - 1).alias("occurrences_beyond_first"),
    ).select(F.lit(table).alias("table_name"), "*")


def column_profile(frame: DataFrame, table: str, numeric: Sequence[str]) -> DataFrame:
    """Missing and zero counts with the range of each numeric column, in one pass."""
    aggregates, rows = [], []
    for i, c in enumerate(numeric):
        value = F.col(c).cast("double")
        aggregates += [
            F.count_if(value.isNull()).alias(f"missing{i}"), F.count_if(value == 0).alias(f"zero{i}"),
            F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}"),
        ]
        rows.append(F.struct(
            F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
            F.col(f"missing{i}").alias("missing_values"), F.col(f"zero{i}").alias("zero_values"),
            F.col(f"min{i}").alias("minimum"), F.col(f"max{i}").alias("maximum"),
        ))
    return frame.agg(*aggregates).select(F.inline(F.array(*rows)))


def composition(frame: DataFrame, relation: str, keys: Sequence[str]) -> DataFrame:
    """How many keys own one row, several rows, and the largest group."""
    n = F.col("n")
    return frame.groupBy(*keys).agg(F.count("*").alias("n")).agg(
        F.count_if(n == 1).alias("single_row_keys"),
        F.count_if(n > 1).alias("multi_row_keys"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("rows_of_multi_row_keys"),
        F.max(n).alias("largest_group"),
    ).select(F.lit(relation).alias("relation"), "*")


def item_mix(items: DataFrame) -> DataFrame:
    """Orders with several products, several sellers, or a repeated product."""
    per_order = items.groupBy("order_id").agg(
        F.count("*").alias("n"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("seller_id").alias("sellers"),
    )
    return per_order.agg(
        F.count_if(F.col("products") > 1).alias("multi_product_orders"),
        F.count_if(F.col("sellers") > 1).alias("multi_seller_orders"),
        F.count_if(F.col("products") < F.col("n")).alias("repeated_product_orders"),
    )


def sequence_audit(frame: DataFrame, key: str, number: str) -> DataFrame:
    """Groups whose numbers are exactly 1..N, and groups where they are not."""
    value = F.col(number)
    groups = frame.groupBy(key).agg(
        F.min(value).alias("low"), F.max(value).alias("high"),
        F.count("*").alias("n"), F.count_distinct(value).alias("distinct"),
    )
    dense = (F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("distinct") == F.col("n"))
    return groups.agg(
        F.count_if(dense).alias("continuous_groups"), F.count_if(~dense).alias("broken_groups")
    )


def value_counts(frame: DataFrame, table: str, column: str) -> DataFrame:
    return frame.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "n"
    )


def zip_format(frame: DataFrame, table: str, column: str) -> DataFrame:
    """Rows, five-digit rows, leading-zero rows and distinct prefixes with a leading zero."""
    zips = frame.groupBy(F.col(column).alias("zip")).agg(F.count("*").alias("n"))
    five, zero = F.col("zip").rlike("^[0-9]{5}$"), F.col("zip").startswith("0")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return zips.agg(
        F.count("*").alias("distinct_prefixes"),
        total(five).alias("five_digit_rows"),
        total(zero).alias("leading_zero_rows"),
        F.count_if(zero).alias("leading_zero_prefixes"),
    ).select(F.lit(table).alias("table_name"), "*")


def order_anomalies(orders: DataFrame) -> DataFrame:
    """Status/date contradictions and time travel, as one row of counts."""
    status = F.col("order_status") == "delivered"
    delivered = F.col("order_delivered_customer_date")
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    return orders.agg(
        F.count_if(status & delivered.isNull()).alias("delivered_without_date"),
        F.count_if(~status & delivered.isNotNull()).alias("undelivered_with_date"),
        F.count_if(approved.isNull()).alias("missing_approval"),
        F.count_if(approved < bought).alias("approved_before_purchase"),
        F.count_if(delivered < approved).alias("delivered_before_approval"),
    )


def child_coverage_by_status(orders: DataFrame, child: DataFrame, relation: str) -> DataFrame:
    """Orders per status with and without child rows."""
    owners = child.select("order_id").distinct().withColumn("found", F.lit(True))
    return orders.join(owners, "order_id", "left").groupBy("order_status").agg(
        F.count("found").alias("with_rows"), F.count_if(F.col("found").isNull()).alias("without_rows")
    ).select(F.lit(relation).alias("relation"), "*")


def lookup_coverage(
    frame: DataFrame, column: str, lookup: DataFrame, lookup_column: str, relation: str
) -> DataFrame:
    """Distinct keys found, distinct keys missing, and lookup keys nobody uses."""
    used = frame.where(F.col(column).isNotNull()).select(F.col(column).alias("key")).distinct()
    known = lookup.where(F.col(lookup_column).isNotNull()).select(F.col(lookup_column).alias("key")).distinct()
    sides = used.withColumn("used", F.lit(True)).join(known.withColumn("known", F.lit(True)), "key", "full_outer")
    return sides.agg(
        F.count_if(F.col("used") & F.col("known")).alias("keys_found"),
        F.count_if(F.col("used") & F.col("known").isNull()).alias("keys_missing"),
        F.count_if(F.col("used").isNull()).alias("keys_unused"),
    ).select(F.lit(relation).alias("relation"), "*")


def coverage_audit(sources: dict[str, DataFrame]) -> DataFrame:
    """Every lookup of the feature build, in both directions."""
    geo = (sources["geolocation"], "geolocation_zip_code_prefix")
    checks = (
        ("customers->geolocation", sources["customers"], "customer_zip_code_prefix", *geo),
        ("sellers->geolocation", sources["sellers"], "seller_zip_code_prefix", *geo),
        ("items->products", sources["items"], "product_id", sources["products"], "product_id"),
        ("items->sellers", sources["items"], "seller_id", sources["sellers"], "seller_id"),
        ("products->translations", sources["products"], "product_category_name",
         sources["translations"], "product_category_name"),
    )
    return union_all(lookup_coverage(f, c, l, lc, name) for name, f, c, l, lc in checks)
