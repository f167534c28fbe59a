"""SQL views behind the checks: the retail tables seen as the order sources.

Each view is a CTE; ``compose`` emits the ones a statement needs, in order.
"""

from __future__ import annotations

import re

KM = """2.0 * 6371.0088 * asin(sqrt(least(1.0::DOUBLE, greatest(0.0::DOUBLE,
  pow(sin((radians(slat) - radians(clat)) / 2), 2)
  + cos(radians(clat)) * cos(radians(slat)) * pow(sin((radians(slng) - radians(clng)) / 2), 2)))))"""

VIEWS = {
    "v_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'P' THEN 'canceled' ELSE 'delivered' END AS order_status,
  bought AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 97 <> 0 THEN bought + to_seconds(((o_orderkey * 37) % 4320) * 60) END AS order_approved_at,
  CASE WHEN o_orderkey % 53 <> 0
    THEN bought + to_seconds((o_orderkey * 31 % 23) * 86400 + (o_orderkey * 17) % 86400) END AS order_delivered_customer_date,
  o_orderdate + to_seconds((15 + o_custkey % 15) * 86400) AS order_estimated_delivery_date
FROM (SELECT *, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS bought FROM orders)""",
    "v_customers": """
SELECT c_custkey AS customer_id, lpad((c_custkey % 600)::VARCHAR, 5, '0') AS customer_zip_code_prefix,
  n_name AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_sellers": """
SELECT s_suppkey AS seller_id, lpad((s_suppkey * 13 % 600)::VARCHAR, 5, '0') AS seller_zip_code_prefix,
  n_name AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "v_items": """
SELECT l_orderkey AS order_id,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    l_quantity, l_discount, l_tax, l_shipdate) AS order_item_id,
  l_partkey AS product_id, l_suppkey AS seller_id, l_extendedprice AS price, l_quantity AS freight_value
FROM lineitem""",
    "v_products": """
SELECT p_partkey AS product_id,
  CASE WHEN p_partkey % 41 <> 0 THEN p_type END AS product_category_name,
  CASE WHEN p_partkey % 101 <> 0 THEN p_size * 10 END::DOUBLE AS product_weight_g,
  CASE WHEN p_partkey % 101 <> 0 THEN p_size + 5 END::DOUBLE AS product_length_cm,
  (p_size % 7 + 2)::DOUBLE AS product_height_cm, (p_size % 11 + 3)::DOUBLE AS product_width_cm
FROM part""",
    "v_translations": """
SELECT * FROM (VALUES ('ECONOMY', 'economy'), ('STANDARD', 'standard'), ('MEDIUM', 'medium'), ('LARGE', 'large'))
  AS t(product_category_name, product_category_name_english)""",
    "v_payments": """
SELECT event_id // 3 AS order_id, event_id % 3 + 1 AS payment_sequential, event_type AS payment_type,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS payment_installments, value AS payment_value
FROM events""",
    "v_geo": """
SELECT lpad((h % 590)::VARCHAR, 5, '0') AS geolocation_zip_code_prefix,
  CASE WHEN h % 211 = 0 THEN 42.184003::DOUBLE ELSE -33.0::DOUBLE + (h * 17 % 3900) / 100.0::DOUBLE END AS geolocation_lat,
  CASE WHEN h % 211 = 0 THEN -8.723762::DOUBLE ELSE -73.0::DOUBLE + (h * 29 % 4400) / 100.0::DOUBLE END AS geolocation_lng
FROM (SELECT event_id // 2 AS h FROM events)""",
    "eligible": """
SELECT order_id, customer_id, order_purchase_timestamp,
  year(order_purchase_timestamp)::INTEGER AS purchase_year,
  month(order_purchase_timestamp)::INTEGER AS purchase_month,
  (isodow(order_purchase_timestamp) - 1)::INTEGER AS purchase_day_of_week,
  hour(order_purchase_timestamp)::INTEGER AS purchase_hour,
  date_diff('second', order_purchase_timestamp, order_approved_at) / 3600.0::DOUBLE AS approval_delay_hours,
  order_approved_at IS NULL AS approval_timestamp_missing,
  date_diff('day', order_purchase_timestamp::DATE, order_estimated_delivery_date::DATE)::INTEGER
    AS promised_delivery_window_days,
  (order_delivered_customer_date::DATE > order_estimated_delivery_date::DATE)::INTEGER AS delay_flag
FROM v_orders
WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
  AND order_estimated_delivery_date IS NOT NULL""",
    "cohort": """
SELECT * FROM eligible WHERE order_id IN (SELECT l_orderkey FROM lineitem)""",
    "lines": """
SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
  CASE WHEN p.product_category_name IS NULL THEN '__missing_category__'
    WHEN t.product_category_name_english IS NULL THEN '__untranslated__:' || p.product_category_name
    ELSE t.product_category_name_english END AS normalized_product_category,
  t.product_category_name_english IS NULL AS product_category_fallback,
  (product_weight_g IS NULL OR product_length_cm IS NULL OR product_height_cm IS NULL OR product_width_cm IS NULL)
    AS product_measurement_missing,
  product_weight_g,
  product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3,
  s.seller_zip_code_prefix, s.seller_state
FROM v_items i
LEFT JOIN v_products p ON i.product_id = p.product_id
LEFT JOIN v_translations t ON p.product_category_name = t.product_category_name
LEFT JOIN v_sellers s ON i.seller_id = s.seller_id""",
    "top_category": """
SELECT order_id, normalized_product_category AS primary_product_category FROM (
  SELECT order_id, normalized_product_category, row_number() OVER (PARTITION BY order_id
    ORDER BY sum(price::DECIMAL(18,2)) DESC, count(*) DESC, normalized_product_category) AS rn
  FROM lines GROUP BY order_id, normalized_product_category) WHERE rn = 1""",
    "top_seller": """
SELECT order_id, seller_state AS primary_seller_state FROM (
  SELECT order_id, seller_id, min(seller_state) AS seller_state, row_number() OVER (PARTITION BY order_id
    ORDER BY sum(price::DECIMAL(18,2)) DESC, count(*) DESC, seller_id) AS rn
  FROM lines GROUP BY order_id, seller_id) WHERE rn = 1""",
    "item_agg": """
SELECT a.*, primary_product_category, primary_seller_state FROM (
  SELECT order_id, count(*) AS item_row_count, count(DISTINCT product_id) AS distinct_product_count,
    count(DISTINCT seller_id) AS distinct_seller_count,
    sum(price::DECIMAL(18,2))::DOUBLE AS item_price_total,
    sum(freight_value::DECIMAL(18,2))::DOUBLE AS freight_value_total,
    sum(product_measurement_missing::INTEGER)::BIGINT AS product_measurement_missing_item_count,
    sum(product_category_fallback::INTEGER)::BIGINT AS product_category_fallback_item_count,
    CASE WHEN count(product_weight_g) = count(*) THEN sum(product_weight_g) END AS product_weight_g_total,
    CASE WHEN count(product_volume_cm3) = count(*) THEN sum(product_volume_cm3) END AS product_volume_cm3_total
  FROM lines GROUP BY order_id) a
JOIN top_category USING (order_id) JOIN top_seller USING (order_id)""",
    "top_payment": """
SELECT order_id, payment_type AS primary_payment_type FROM (
  SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id
    ORDER BY sum(payment_value::DECIMAL(18,2)) DESC, count(*) DESC, payment_type) AS rn
  FROM v_payments GROUP BY order_id, payment_type) WHERE rn = 1""",
    "pay_agg": """
SELECT a.*, primary_payment_type FROM (
  SELECT order_id, count(*) AS payment_row_count, count(DISTINCT payment_type) AS distinct_payment_type_count,
    sum(payment_value::DECIMAL(18,2))::DOUBLE AS payment_value_total,
    max(payment_installments) AS max_payment_installments
  FROM v_payments GROUP BY order_id) a JOIN top_payment USING (order_id)""",
    "centroids": """
SELECT geolocation_zip_code_prefix, median(geolocation_lat) AS zip_latitude, median(geolocation_lng) AS zip_longitude
FROM (SELECT DISTINCT * FROM v_geo
  WHERE geolocation_lat BETWEEN -34 AND 6 AND geolocation_lng BETWEEN -74 AND -28)
GROUP BY geolocation_zip_code_prefix""",
    "pairs": """
SELECT DISTINCT order_id, seller_id, seller_zip_code_prefix FROM lines
WHERE order_id IN (SELECT order_id FROM cohort)""",
    "placed": """
SELECT c.order_id, v.customer_state, v.customer_zip_code_prefix, z.zip_latitude AS clat, z.zip_longitude AS clng
FROM cohort c LEFT JOIN v_customers v ON c.customer_id = v.customer_id
LEFT JOIN centroids z ON v.customer_zip_code_prefix = z.geolocation_zip_code_prefix""",
    "pair_km": f"""
SELECT order_id, seller_id, clat, clng, slat, slng,
  CASE WHEN clat IS NOT NULL AND clng IS NOT NULL AND slat IS NOT NULL AND slng IS NOT NULL THEN {KM} END AS km
FROM (SELECT p.order_id, p.seller_id, o.clat, o.clng, z.zip_latitude AS slat, z.zip_longitude AS slng
  FROM pairs p LEFT JOIN placed o ON p.order_id = o.order_id
  LEFT JOIN centroids z ON p.seller_zip_code_prefix = z.geolocation_zip_code_prefix)""",
    "dist_agg": """
SELECT order_id, count(*) - count(km) AS seller_customer_distance_missing_count,
  round(min(km), 6) AS seller_customer_distance_km_min,
  round(avg(km), 6) AS seller_customer_distance_km_mean,
  round(max(km), 6) AS seller_customer_distance_km_max
FROM pair_km GROUP BY order_id""",
    "features": """
SELECT c.order_id, c.order_purchase_timestamp, c.purchase_year, c.purchase_month, c.purchase_day_of_week,
  c.purchase_hour, c.approval_delay_hours, c.approval_timestamp_missing, c.promised_delivery_window_days,
  l.customer_state, i.item_row_count, i.distinct_product_count, i.distinct_seller_count,
  i.item_price_total, i.freight_value_total, i.product_weight_g_total, i.product_volume_cm3_total,
  i.product_measurement_missing_item_count, i.product_category_fallback_item_count,
  i.primary_product_category, i.primary_seller_state,
  coalesce(p.payment_row_count, 0)::BIGINT AS payment_row_count,
  coalesce(p.distinct_payment_type_count, 0)::BIGINT AS distinct_payment_type_count,
  coalesce(p.payment_value_total, 0.0)::DOUBLE AS payment_value_total,
  coalesce(p.max_payment_installments, 0)::BIGINT AS max_payment_installments,
  coalesce(p.primary_payment_type, '__missing_payment__') AS primary_payment_type,
  p.order_id IS NULL AS payment_data_missing,
  (l.clat IS NULL OR l.clng IS NULL) AS customer_geolocation_missing,
  d.seller_customer_distance_missing_count, d.seller_customer_distance_km_min,
  d.seller_customer_distance_km_mean, d.seller_customer_distance_km_max, c.delay_flag
FROM cohort c JOIN placed l ON c.order_id = l.order_id JOIN item_agg i ON c.order_id = i.order_id
LEFT JOIN pay_agg p ON c.order_id = p.order_id JOIN dist_agg d ON c.order_id = d.order_id""",
    # A deterministic stand-in score with ties, for the metric operators.
    "scored": """
SELECT order_id, order_purchase_timestamp, delay_flag, ((order_id * 7919) % 1000) / 1000.0::DOUBLE AS risk_score
FROM cohort""",
    "split": """
SELECT *, CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train'
    WHEN rn <= floor(n * (0.70::DOUBLE + 0.15::DOUBLE)) THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) AS rn, count(*) OVER () AS n
  FROM cohort)""",
    "curve": """
SELECT risk_score, n, pos, sum(n) OVER (ORDER BY risk_score DESC)::BIGINT AS predicted,
  sum(pos) OVER (ORDER BY risk_score DESC)::BIGINT AS tp, sum(n) OVER ()::BIGINT AS total, sum(pos) OVER ()::BIGINT AS late
FROM (SELECT risk_score, count(*) AS n, sum(delay_flag)::BIGINT AS pos FROM scored GROUP BY risk_score)""",
}


def _needs(sql: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]


def compose(sql: str, **extra: str) -> str:
    """Prefix ``sql`` with the views it uses, directly or through other views.

    ``extra`` adds statement-specific CTEs after the shared ones.
    """
    wanted: set[str] = set()
    stack = [sql, *extra.values()]
    while stack:
        for name in _needs(stack.pop()):
            if name not in wanted and name not in extra:
                wanted.add(name)
                stack.append(VIEWS[name])
    ctes = [f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in wanted] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(ctes)}\n{sql}" if ctes else sql
