"""Adapter: retail benchmark tables seen as the eight order sources.

The tables hold no delivery, payment or coordinate columns, so these are
derived by fixed integer arithmetic on the keys. Fixed values below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from parceltide.session import bound_tasks

TRANSLATIONS = (
    ("ECONOMY", "economy"), ("STANDARD", "standard"), ("MEDIUM", "medium"), ("LARGE", "large"),
)
_DAY = 86400

# Declared schemas: no inference job per table.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _zip(expression: str):
    return F.lpad(F.expr(expression).cast("string"), 5, "0")


def retail_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    bound_tasks(spark, [f"{folder}/{name}.parquet" for name in ("orders", "lineitem", "events")])
    table = lambda name: read_table(spark, folder, name)
    states = table("nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("state"))
    orders, lineitem, events, part = (table(n) for n in ("orders", "lineitem", "events", "part"))

    later = lambda seconds, start: F.expr(f"timestampadd(SECOND, {seconds}, {start})")
    dated = orders.withColumn("bought", later("(o_orderkey * 7919) % 86400", "o_orderdate"))
    return {
        "orders": dated.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") == "P", "canceled").otherwise("delivered").alias("order_status"),
            F.col("bought").alias("order_purchase_timestamp"),
            F.when(F.col("o_orderkey") % 97 != 0, later("((o_orderkey * 37) % 4320) * 60", "bought"))
            .alias("order_approved_at"),
            F.when(
                F.col("o_orderkey") % 53 != 0,
                later(f"(o_orderkey * 31 % 23) * {_DAY} + (o_orderkey * 17) % {_DAY}", "bought"),
            ).alias("order_delivered_customer_date"),
            later(f"(15 + o_custkey % 15) * {_DAY}", "o_orderdate").alias("order_estimated_delivery_date"),
        ),
        "customers": table("customer").join(states, F.col("c_nationkey") == F.col("key")).select(
            F.col("c_custkey").alias("customer_id"),
            _zip("c_custkey % 600").alias("customer_zip_code_prefix"),
            F.col("state").alias("customer_state"),
        ),
        "items": lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.row_number().over(
                Window.partitionBy("l_orderkey").orderBy(
                    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                    "l_quantity", "l_discount", "l_tax", "l_shipdate",
                )
            ).cast("bigint").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("freight_value"),
        ),
        "products": part.select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 41 != 0, F.col("p_type")).alias("product_category_name"),
            F.when(F.col("p_partkey") % 101 != 0, F.col("p_size") * 10).cast("double").alias("product_weight_g"),
            F.when(F.col("p_partkey") % 101 != 0, F.col("p_size") + 5).cast("double").alias("product_length_cm"),
            (F.col("p_size") % 7 + 2).cast("double").alias("product_height_cm"),
            (F.col("p_size") % 11 + 3).cast("double").alias("product_width_cm"),
        ),
        "sellers": table("supplier").join(states, F.col("s_nationkey") == F.col("key")).select(
            F.col("s_suppkey").alias("seller_id"),
            _zip("s_suppkey * 13 % 600").alias("seller_zip_code_prefix"),
            F.col("state").alias("seller_state"),
        ),
        "payments": events.select(
            F.expr("event_id div 3").alias("order_id"),
            (F.col("event_id") % 3 + 1).alias("payment_sequential"),
            F.col("event_type").alias("payment_type"),
            F.get_json_object("props", "$.k").cast("bigint").alias("payment_installments"),
            F.col("value").alias("payment_value"),
        ),
        "geolocation": events.withColumn("h", F.expr("event_id div 2")).select(
            _zip("h % 590").alias("geolocation_zip_code_prefix"),
            F.when(F.col("h") % 211 == 0, F.lit(42.184003))
            .otherwise(F.lit(-33.0) + (F.col("h") * 17 % 3900) / F.lit(100.0)).alias("geolocation_lat"),
            F.when(F.col("h") % 211 == 0, F.lit(-8.723762))
            .otherwise(F.lit(-73.0) + (F.col("h") * 29 % 4400) / F.lit(100.0)).alias("geolocation_lng"),
        ),
        "translations": spark.sql(
            f"SELECT * FROM VALUES {', '.join(map(str, TRANSLATIONS))} "
            "AS t(product_category_name, product_category_name_english)"
        ),
    }
