"""Source and feature contracts: column names, order, types and roles."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# File names and exact header order of the eight sources.
# ---------------------------------------------------------------------------
SOURCE_FILES = {
    "orders": "olist_orders_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "items": "olist_order_items_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "translations": "product_category_name_translation.csv",
}

SOURCE_HEADERS = {
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "customers": (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state",
    ),
    "items": (
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
        "freight_value",
    ),
    "products": (
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm",
    ),
    "sellers": (
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
    ),
    "payments": (
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
        "geolocation_state",
    ),
    "translations": (
        "product_category_name", "product_category_name_english",
    ),
}

# The columns of each source that are read.
USED_COLUMNS = {
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "customers": ("customer_id", "customer_zip_code_prefix", "customer_state"),
    "items": ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
    "products": (
        "product_id", "product_category_name", "product_weight_g", "product_length_cm", "product_height_cm",
        "product_width_cm",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_state"),
    "payments": ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
    "translations": ("product_category_name", "product_category_name_english"),
}

# Parsed types; columns not named here stay strings.
TIMESTAMP_COLUMNS = {
    "orders": (
        "order_purchase_timestamp", "order_approved_at",
        "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
}
DECIMAL_NUMBER_COLUMNS = {
    "items": ("price", "freight_value"),
    "products": ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
    "payments": ("payment_value",),
    "geolocation": ("geolocation_lat", "geolocation_lng"),
}
WHOLE_NUMBER_COLUMNS = {
    "items": ("order_item_id",),
    "payments": ("payment_sequential", "payment_installments"),
}

UNIQUE_KEYS = {
    "orders": ("order_id",),
    "customers": ("customer_id",),
    "items": ("order_id", "order_item_id"),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "payments": ("order_id", "payment_sequential"),
    "translations": ("product_category_name",),
}

# (child, parent, child key, parent key)
REFERENCES = (
    ("orders", "customers", "customer_id", "customer_id"),
    ("items", "orders", "order_id", "order_id"),
    ("payments", "orders", "order_id", "order_id"),
    ("items", "products", "product_id", "product_id"),
    ("items", "sellers", "seller_id", "seller_id"),
)

# Columns that may be empty; every other used column must be present.
NULLABLE_SOURCE_COLUMNS = {
    "orders": {"order_approved_at", "order_delivered_customer_date"},
    "products": {
        "product_category_name", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm",
    },
}
NONNEGATIVE_COLUMNS = {
    "items": ("price", "freight_value"),
    "products": DECIMAL_NUMBER_COLUMNS["products"],
    "payments": ("payment_sequential", "payment_installments", "payment_value"),
}

# ---------------------------------------------------------------------------
# The 33-column feature row, in output order.
# (name, Spark type, nullable in the stored table)
# ---------------------------------------------------------------------------
_FEATURE_FIELDS = (
    ("order_id", "string", False),
    ("order_purchase_timestamp", "timestamp_ntz", True),
    ("purchase_year", "int", True),
    ("purchase_month", "int", True),
    ("purchase_day_of_week", "int", True),
    ("purchase_hour", "int", True),
    ("approval_delay_hours", "double", True),
    ("approval_timestamp_missing", "boolean", False),
    ("promised_delivery_window_days", "int", True),
    ("customer_state", "string", True),
    ("item_row_count", "bigint", True),
    ("distinct_product_count", "bigint", True),
    ("distinct_seller_count", "bigint", True),
    ("item_price_total", "double", True),
    ("freight_value_total", "double", True),
    ("product_weight_g_total", "double", True),
    ("product_volume_cm3_total", "double", True),
    ("product_measurement_missing_item_count", "bigint", True),
    ("product_category_fallback_item_count", "bigint", True),
    ("primary_product_category", "string", True),
    ("primary_seller_state", "string", True),
    ("payment_row_count", "bigint", False),
    ("distinct_payment_type_count", "bigint", False),
    ("payment_value_total", "double", False),
    ("max_payment_installments", "bigint", False),
    ("primary_payment_type", "string", False),
    ("payment_data_missing", "boolean", False),
    ("customer_geolocation_missing", "boolean", False),
    ("seller_customer_distance_missing_count", "bigint", True),
    ("seller_customer_distance_km_min", "double", True),
    ("seller_customer_distance_km_mean", "double", True),
    ("seller_customer_distance_km_max", "double", True),
    ("delay_flag", "int", False),
)
FEATURE_TYPES = {name: kind for name, kind, _ in _FEATURE_FIELDS}
FEATURE_ROW = tuple(FEATURE_TYPES)
NOT_NULL_FEATURES = tuple(name for name, _, nullable in _FEATURE_FIELDS if not nullable)

ORDER_KEY = "order_id"
PURCHASE_TIME = "order_purchase_timestamp"
TARGET = "delay_flag"
METADATA = (ORDER_KEY, PURCHASE_TIME)
MODEL_FEATURES = tuple(c for c in FEATURE_ROW if c not in (*METADATA, TARGET))
CATEGORICAL_FEATURES = (
    "customer_state", "primary_product_category", "primary_seller_state", "primary_payment_type",
)
NUMERIC_FEATURES = tuple(c for c in MODEL_FEATURES if c not in CATEGORICAL_FEATURES)
FLAG_FEATURES = tuple(c for c in MODEL_FEATURES if FEATURE_TYPES[c] == "boolean")
NULLABLE_FEATURES = (
    "approval_delay_hours", "product_weight_g_total", "product_volume_cm3_total",
    "seller_customer_distance_km_min", "seller_customer_distance_km_mean",
    "seller_customer_distance_km_max",
)
FLOAT_FEATURES = tuple(c for c in FEATURE_ROW if FEATURE_TYPES[c] == "double")

# Columns that must never become model inputs.
FORBIDDEN_FEATURES = frozenset((
    "order_id", "customer_id", "customer_unique_id", "order_item_id", "product_id", "seller_id",
    "payment_sequential", "review_id", "order_status", "order_delivered_carrier_date",
    "order_delivered_customer_date", "shipping_limit_date", "review_score", "review_comment_title",
    "review_comment_message", "review_creation_date", "review_answer_timestamp", "delay_flag",
))

# Metrics of the audited dataset, used by the known-metric gate.
AUDITED_METRICS = {
    "rows": 96470,
    "unique_order_id": 96470,
    "late": 6534,
    "on_time": 89936,
    "eligible_orders_without_payment": 1,
}

# Placeholders and geography.
MISSING_CATEGORY = "__missing_category__"
UNTRANSLATED_PREFIX = "__untranslated__:"
MISSING_PAYMENT = "__missing_payment__"
MISSING_LABEL = "__missing__"
DELIVERED = "delivered"
LATITUDE_ENVELOPE = (-34.0, 6.0)
LONGITUDE_ENVELOPE = (-74.0, -28.0)
EARTH_RADIUS_KM = 6371.0088

# Chronological split and report fractions.
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.15
TOP_FRACTIONS = (0.05, 0.10, 0.20)
SEED = 42


def csv_schema(source: str) -> T.StructType:
    """All-string read schema; identifiers and ZIP prefixes keep leading zeros."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in SOURCE_HEADERS[source]])


def feature_schema(order_key_type: str = "string") -> T.StructType:
    """Spark schema of the stored feature row."""
    kinds = {**FEATURE_TYPES, ORDER_KEY: order_key_type}
    return T.StructType.fromDDL(", ".join(f"{c} {kinds[c]}" for c in FEATURE_ROW))
