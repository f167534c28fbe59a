"""Queries over the feature build: cohort, items, payments, geography, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from parceltide.operators import geography, items as I, orders as O, payments as P
from parceltide.plans.order_features import composed_features, order_features
from parceltide.session import stage
from registry.common import cohort, register, retail_sources
from registry.views import compose


@register("eligible_orders", compose("SELECT * FROM eligible"))
def _(spark, folder):
    return O.eligible_orders(retail_sources(spark, folder)["orders"])


def _lines(spark, folder):
    src = retail_sources(spark, folder)
    return I.enrich_items(src["items"], src["products"], src["translations"], src["sellers"])


LINE_COLUMNS = (
    "order_id, order_item_id, product_id, seller_id, normalized_product_category, product_category_fallback, "
    "product_measurement_missing, product_weight_g, product_volume_cm3, seller_zip_code_prefix, seller_state"
)


@register("item_enrichment", compose(f"SELECT {LINE_COLUMNS} FROM lines"))
def _(spark, folder):
    return _lines(spark, folder).select(*LINE_COLUMNS.split(", "))


@register("item_rollup", compose("SELECT * FROM item_agg"))
def _(spark, folder):
    return I.item_rollup(_lines(spark, folder))


@register("primary_category", compose("SELECT * FROM top_category"))
def _(spark, folder):
    return I.primary_category(_lines(spark, folder))


@register("primary_seller_state", compose("SELECT * FROM top_seller"))
def _(spark, folder):
    return I.primary_seller_state(_lines(spark, folder))


@register("eligible_pairs", compose("SELECT * FROM pairs"))
def _(spark, folder):
    return I.eligible_pairs(I.seller_pairs(_lines(spark, folder)), cohort(spark, folder))


@register("payment_rollup", compose("SELECT * FROM pay_agg"))
def _(spark, folder):
    return P.payment_rollup(retail_sources(spark, folder)["payments"])


@register("primary_payment_type", compose("SELECT * FROM top_payment"))
def _(spark, folder):
    return P.primary_payment_type(retail_sources(spark, folder)["payments"])


@register("payment_profile", compose("""
SELECT e.*, coalesce(p.payment_row_count, 0)::BIGINT AS payment_row_count,
  coalesce(p.distinct_payment_type_count, 0)::BIGINT AS distinct_payment_type_count,
  coalesce(p.payment_value_total, 0.0)::DOUBLE AS payment_value_total,
  coalesce(p.max_payment_installments, 0)::BIGINT AS max_payment_installments,
  coalesce(p.primary_payment_type, '__missing_payment__') AS primary_payment_type,
  p.order_id IS NULL AS payment_data_missing
FROM eligible e LEFT JOIN pay_agg p ON e.order_id = p.order_id"""))
def _(spark, folder):
    src = retail_sources(spark, folder)
    return P.payment_profile(O.eligible_orders(src["orders"]), src["payments"])


@register("zip_centroids", compose("SELECT * FROM centroids"))
def _(spark, folder):
    return geography.zip_centroids(retail_sources(spark, folder)["geolocation"])


@register("zip_centroids_crowded", compose("SELECT * FROM centroids"))
def _(spark, folder):
    """Every ZIP through the sliced route that crowded ZIPs take."""
    return geography.zip_centroids(retail_sources(spark, folder)["geolocation"])


@register("geo_quality", compose("""
SELECT count(*) AS raw_geolocation_rows_outside_brazil_envelope,
  count(DISTINCT (geolocation_zip_code_prefix, geolocation_lat, geolocation_lng))
    AS distinct_coordinate_triples_outside_brazil_envelope,
  count(DISTINCT geolocation_zip_code_prefix) AS zip_prefixes_with_rejected_coordinates,
  (SELECT count(DISTINCT geolocation_zip_code_prefix) FROM v_geo)
    - (SELECT count(*) FROM centroids) AS zip_prefixes_without_valid_coordinates
FROM v_geo
WHERE NOT (geolocation_lat BETWEEN -34 AND 6 AND geolocation_lng BETWEEN -74 AND -28)"""))
def _(spark, folder):
    return geography.geo_quality(retail_sources(spark, folder)["geolocation"])


def _orders_and_pairs(spark, folder):
    """(cohort with customer columns, distinct order-seller pairs with the seller's ZIP), from one pass over the items."""
    src = retail_sources(spark, folder)
    pairs = stage(src["items"].select("order_id", "seller_id").distinct(), "pairs")
    orders = O.eligible_orders(src["orders"]).join(pairs.select("order_id"), "order_id", "left_semi")
    return orders.join(src["customers"], "customer_id", "left").select(
        "order_id", "customer_state", "customer_zip_code_prefix"
    ), pairs.join(src["sellers"], "seller_id", "left").select("order_id", "seller_id", "seller_zip_code_prefix")


@register("distance_features", compose("""
SELECT l.order_id, l.customer_state, l.customer_zip_code_prefix,
  l.clat AS customer_latitude, l.clng AS customer_longitude,
  (l.clat IS NULL OR l.clng IS NULL) AS customer_geolocation_missing,
  d.seller_customer_distance_missing_count, d.seller_customer_distance_km_min,
  d.seller_customer_distance_km_mean, d.seller_customer_distance_km_max
FROM placed l LEFT JOIN dist_agg d ON l.order_id = d.order_id"""))
def _(spark, folder):
    src = retail_sources(spark, folder)
    orders, pairs = _orders_and_pairs(spark, folder)
    orders = stage(orders, "orders")
    centroids = stage(geography.zip_centroids(src["geolocation"]), "centroids")
    return geography.distance_features(orders, I.eligible_pairs(pairs, orders), centroids)


@register("haversine", compose("SELECT order_id, seller_id, round(km, 6) AS km FROM pair_km"))
def _(spark, folder):
    centroids = stage(geography.zip_centroids(retail_sources(spark, folder)["geolocation"]), "centroids")
    orders, pairs = _orders_and_pairs(spark, folder)
    orders = geography.located(orders, centroids, "customer_zip_code_prefix", "customer")
    return geography.located(pairs, centroids, "seller_zip_code_prefix", "seller").join(orders, "order_id").select(
        "order_id", "seller_id", F.round(geography.pair_distance(), 6).alias("km")
    )


@register("order_features", compose("SELECT * FROM features"))
def _(spark, folder):
    return order_features(retail_sources(spark, folder))


@register("order_features_composed", compose("SELECT * FROM features"))
def _(spark, folder):
    return composed_features(retail_sources(spark, folder))
