"""ZIP centroids, coordinate quality and seller-customer distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C
from parceltide.functions.geo import haversine_km, within
from parceltide.operators.selection import quantiles

_ZIP, _LAT, _LNG = "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"


def inside_envelope() -> Column:
    return within(F.col(_LAT), C.LATITUDE_ENVELOPE) & within(F.col(_LNG), C.LONGITUDE_ENVELOPE)


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Exact coordinate-wise median per ZIP over distinct in-envelope points.

    Points of a small ZIP meet in one row; those of a large one are only counted,
    so a ZIP of any size is as good as many small ones.
    """
    points = geolocation.where(inside_envelope()).select(_ZIP, _LAT, _LNG).distinct()
    axes = points.select(
        _ZIP,
        F.inline(F.array(
            F.struct(F.lit("lat").alias("axis"), F.col(_LAT).alias("degrees")),
            F.struct(F.lit("lng").alias("axis"), F.col(_LNG).alias("degrees")),
        )),
    )
    medians = quantiles(axes, "degrees", {"mid": 0.5}, within=[_ZIP, "axis"])
    return medians.groupBy(_ZIP).agg(
        F.max(F.when(F.col("axis") == "lat", F.col("mid"))).alias("zip_latitude"),
        F.max(F.when(F.col("axis") == "lng", F.col("mid"))).alias("zip_longitude"),
    )


def geo_quality(geolocation: DataFrame) -> DataFrame:
    """Rejected rows, distinct rejected points, ZIPs with rejects, ZIPs left without a point.

    Points are counted first, then ZIPs, so both shuffles carry combined rows.
    """
    points = geolocation.groupBy(_ZIP, _LAT, _LNG).agg(F.count("*").alias("rows"))
    bad = ~inside_envelope()
    zips = points.groupBy(_ZIP).agg(
        F.coalesce(F.sum(F.when(bad, F.col("rows"))), F.lit(0)).alias("rows"),
        F.count_if(bad).alias("points"), F.count_if(~bad).alias("good"),
    )
    return zips.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_geolocation_rows_outside_brazil_envelope"),
        F.coalesce(F.sum("points"), F.lit(0)).alias("distinct_coordinate_triples_outside_brazil_envelope"),
        F.count_if(F.col("points") > 0).alias("zip_prefixes_with_rejected_coordinates"),
        F.count_if(F.col("good") == 0).alias("zip_prefixes_without_valid_coordinates"),
    )


def located(frame: DataFrame, centroids: DataFrame, zip_column: str, prefix: str) -> DataFrame:
    """Left join of the centroids in one role (customer or seller)."""
    role = centroids.select(
        F.col(_ZIP).alias(zip_column),
        F.col("zip_latitude").alias(f"{prefix}_latitude"),
        F.col("zip_longitude").alias(f"{prefix}_longitude"),
    )
    return frame.join(role, zip_column, "left")


def pair_distance() -> Column:
    return haversine_km(
        F.col("customer_latitude"), F.col("customer_longitude"),
        F.col("seller_latitude"), F.col("seller_longitude"),
    )


def distance_features(orders: DataFrame, pairs: DataFrame, centroids: DataFrame) -> DataFrame:
    """Orders with customer coordinates and min/mean/max distance to their sellers."""
    placed = located(orders, centroids, "customer_zip_code_prefix", "customer").withColumn(
        "customer_geolocation_missing",
        F.col("customer_latitude").isNull() | F.col("customer_longitude").isNull(),
    )
    measured = (
        located(pairs, centroids, "seller_zip_code_prefix", "seller")
        .join(placed.select("order_id", "customer_latitude", "customer_longitude"), "order_id", "left")
        .withColumn("km", pair_distance())
    )
    km = F.col("km")
    rollup = measured.groupBy("order_id").agg(
        F.round(F.min(km), 6).alias("seller_customer_distance_km_min"),
        F.round(F.avg(km), 6).alias("seller_customer_distance_km_mean"),
        F.round(F.max(km), 6).alias("seller_customer_distance_km_max"),
        F.count_if(km.isNull()).alias("seller_customer_distance_missing_count"),
    )
    return placed.join(rollup, "order_id", "left")
