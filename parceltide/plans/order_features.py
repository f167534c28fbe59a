"""The 33-column feature table as one Spark plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parceltide import contracts as C
from parceltide.operators import geography, items as item_ops, validate
from parceltide.operators.orders import delivered_cohort, eligible_orders, purchase_features
from parceltide.operators.payments import payment_features, payment_rollup
from parceltide.plans.ingest import is_ingested
from parceltide.session import apply_skew_settings, stage

# Columns of the order row that ride along with its lines.
_CARRIED = ("order_purchase_timestamp", "order_approved_at", "estimated_date", "customer_state", C.TARGET)
# Keys of the facets too; no floats, whose normalisation would hide the order of the rows from the planner.
_ORDER_KEYS = (*_CARRIED, "customer_zip_code_prefix", "customer_geolocation_missing")


def order_features(sources: dict[str, DataFrame], centroids: DataFrame | None = None) -> DataFrame:
    """One row per eligible order with items, unsorted.

    The items are the largest input and move through the network once:

    1. cohort + customer + customer centroid: one narrow row per order;
    2. items pick up product and seller attributes, by broadcast where the
       dimension is small; the centroid is attached to the seller dimension,
       not to the items;
    3. last they join the order row on order_id, so that what follows finds its
       rows together; each line fans out to its product, seller and category facet, and facets
       are combined per (order, facet key): distinct counts, primary values and
       distinct-seller distances all come from these subtotals;
    4. subtotals are combined per order and meet the payment rollup.

    Steps 3 and 4 share one order_id partitioning, also where the dimensions are
    too large to broadcast. A hot order is split by adaptive execution, which
    then adds a combining exchange.
    """
    apply_skew_settings(sources["orders"].sparkSession)
    # The dimensions are stored first. Their size is then a measured number, and
    # the planner broadcasts one only when it is below its threshold; estimated
    # join sizes would shuffle the items once more per dimension.
    if centroids is None:
        centroids = stage(geography.zip_centroids(sources["geolocation"]), "centroids")

    placed = geography.located(
        validate.join_checked(delivered_cohort(sources["orders"]), sources["customers"], "customer_id", name="customers"),
        centroids, "customer_zip_code_prefix", "customer",
    ).select("order_id", *_CARRIED, "customer_zip_code_prefix", "customer_latitude", "customer_longitude")
    products = stage(validate.one_per_key(
        item_ops.product_profiles(sources["products"], sources["translations"]), ["product_id"]
    ), "products")
    sellers = stage(validate.one_per_key(
        geography.located(sources["sellers"], centroids, "seller_zip_code_prefix", "seller").select(
            "seller_id", "seller_state", "seller_latitude", "seller_longitude"
        ), ["seller_id"],
    ), "sellers")
    lines = sources["items"].select("order_id", "product_id", "seller_id", "price", "freight_value")
    lines = validate.join_counted(lines, products, ["product_id"], name="products")
    lines = validate.join_counted(lines, sellers, ["seller_id"], name="sellers").join(placed, "order_id")
    lines = lines.withColumns({
        "km": geography.pair_distance(),
        "customer_geolocation_missing": F.col("customer_latitude").isNull() | F.col("customer_longitude").isNull(),
    })
    facets = item_ops.facet_subtotals(lines, _ORDER_KEYS, ("km",), one_state=True)
    per_order = _combine(facets)
    return per_order.join(payment_rollup(sources["payments"]), "order_id", "left").select(
        *_output_columns(per_order)
    )


def _combine(facets: DataFrame) -> DataFrame:
    """Facet subtotals to one row per order, with distances to its distinct sellers."""
    at_seller = F.col("facet") == item_ops.SELLER
    km = F.col("km")  # NULL in the other facets
    return facets.groupBy("order_id", *_CARRIED).agg(
        F.max("customer_geolocation_missing").alias("customer_geolocation_missing"),
        *item_ops.facet_totals(),
        F.count_if(at_seller & km.isNull()).alias("seller_customer_distance_missing_count"),
        F.round(F.min(km), 6).alias("seller_customer_distance_km_min"),
        F.round(F.avg(km), 6).alias("seller_customer_distance_km_mean"),
        F.round(F.max(km), 6).alias("seller_customer_distance_km_max"),
    )


def _output_columns(per_order: DataFrame) -> list:
    kinds = {**C.FEATURE_TYPES, C.ORDER_KEY: dict(per_order.dtypes)[C.ORDER_KEY]}
    # Same column names in both lists of expressions, so look them up by output name.
    purchase = (
        "purchase_year", "purchase_month", "purchase_day_of_week", "purchase_hour", "approval_delay_hours",
        "approval_timestamp_missing", "promised_delivery_window_days",
    )
    payment = (
        "payment_row_count", "distinct_payment_type_count", "payment_value_total", "max_payment_installments",
        "primary_payment_type", "payment_data_missing",
    )
    derived = {
        **dict(zip(purchase, purchase_features())), **dict(zip(payment, payment_features())),
    }
    return [derived.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in C.FEATURE_ROW]


def composed_features(sources: dict[str, DataFrame], centroids: DataFrame | None = None) -> DataFrame:
    """The same table built operator by operator, for cross-checking the fused plan.

    Reads the items once per rollup, so it moves more data than ``order_features``.
    """
    if centroids is None:
        centroids = stage(geography.zip_centroids(sources["geolocation"]), "centroids")
    lines = item_ops.enrich_items(
        sources["items"], sources["products"], sources["translations"], sources["sellers"]
    )
    orders = eligible_orders(sources["orders"]).join(sources["customers"], "customer_id", "left")
    orders = orders.join(item_ops.item_rollup(lines), "order_id")
    orders = orders.join(payment_rollup(sources["payments"]), "order_id", "left").select(
        *[orders[c] for c in orders.columns], *payment_features()
    )
    pairs = item_ops.eligible_pairs(item_ops.seller_pairs(lines), orders)
    full = geography.distance_features(orders, pairs, centroids)
    kinds = {**C.FEATURE_TYPES, C.ORDER_KEY: dict(full.dtypes)[C.ORDER_KEY]}
    return full.select(*[F.col(c).cast(kinds[c]).alias(c) for c in C.FEATURE_ROW])


def build_order_features(sources: dict[str, DataFrame], one_order_per_customer: bool = True) -> DataFrame:
    """Validate typed sources, then build. Raises before any feature is computed.

    Row rules are not repeated for sources that come from ``ingest``.
    """
    validate.validate_sources(
        sources, one_order_per_customer, row_rules=not is_ingested(sources), items_of_eligible=True
    )
    features = order_features(sources)
    validate.check_feature_layout(features)
    return features
