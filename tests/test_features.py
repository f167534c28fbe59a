import math

import pytest

from parceltide import contracts as C
from parceltide.functions.geo import haversine_km
from parceltide.operators import geography, items as I, quality as Q, validate as V
from parceltide.operators.orders import elapsed_seconds, eligible_orders
from parceltide.operators.payments import payment_rollup
from parceltide.plans.order_features import build_order_features, composed_features, order_features
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(mini):
    return {r["order_id"]: r for r in order_features(mini).collect()}


def as_set(frame):
    return sorted(map(str, frame.select(*C.FEATURE_ROW).collect()))


def test_target_and_grain(rows):
    assert {k: r["delay_flag"] for k, r in rows.items()} == {"o1": 0, "o2": 1, "o3": 0}


def test_purchase_features(rows):
    o1, o2, o3 = rows["o1"], rows["o2"], rows["o3"]
    assert (o1["purchase_year"], o1["purchase_month"], o1["purchase_day_of_week"], o1["purchase_hour"]) == (2018, 1, 0, 10)
    assert (o2["purchase_day_of_week"], o2["purchase_hour"]) == (5, 23)
    assert o1["approval_delay_hours"] == 1.5 and o1["promised_delivery_window_days"] == 9
    assert o3["approval_timestamp_missing"] and o3["approval_delay_hours"] is None


def test_items_do_not_multiply_orders(rows):
    o1 = rows["o1"]
    assert (o1["item_row_count"], o1["distinct_product_count"], o1["distinct_seller_count"]) == (2, 2, 2)
    assert (o1["item_price_total"], o1["freight_value_total"]) == (20.0, 5.0)
    assert (o1["product_weight_g_total"], o1["product_volume_cm3_total"]) == (150.0, 164.0)


def test_ties_take_the_smallest_key(rows):
    o1 = rows["o1"]
    assert o1["primary_product_category"] == "art"
    assert o1["primary_seller_state"] == "SP"  # sX before sY
    assert o1["primary_payment_type"] == "boleto"


def test_order_without_payment_is_kept(rows):
    o3 = rows["o3"]
    assert o3["payment_data_missing"] and o3["primary_payment_type"] == "__missing_payment__"
    assert (o3["payment_row_count"], o3["distinct_payment_type_count"], o3["max_payment_installments"]) == (0, 0, 0)
    assert o3["payment_value_total"] == 0.0
    assert rows["o1"]["payment_value_total"] == 25.0 and rows["o1"]["max_payment_installments"] == 2


def test_missing_product_attributes(rows):
    o3 = rows["o3"]
    assert o3["primary_product_category"] == "__missing_category__"
    assert (o3["product_category_fallback_item_count"], o3["product_measurement_missing_item_count"]) == (1, 1)
    assert o3["product_weight_g_total"] is None and o3["product_volume_cm3_total"] is None


def test_missing_geolocation_keeps_the_order(rows):
    o3 = rows["o3"]
    assert o3["customer_geolocation_missing"] and o3["seller_customer_distance_missing_count"] == 1
    assert o3["seller_customer_distance_km_mean"] is None
    assert rows["o1"]["seller_customer_distance_km_min"] == 0.0
    assert rows["o1"]["seller_customer_distance_km_max"] > 1000


def test_untranslated_category(mini):
    no_art = {**mini, "translations": mini["translations"].where("product_category_name <> 'arte'")}
    row = order_features(no_art).where("order_id = 'o1'").first()
    assert row["primary_product_category"] == "__untranslated__:arte"
    assert row["product_category_fallback_item_count"] == 1


def test_fused_and_composed_plans_agree(mini):
    assert as_set(order_features(mini)) == as_set(composed_features(mini))


def test_result_does_not_depend_on_input_order(mini):
    shuffled = {n: f.repartition(3, F.rand(7)) for n, f in mini.items()}
    assert as_set(order_features(mini)) == as_set(order_features(shuffled))


def test_unmatched_product_and_itemless_order_fail(mini):
    with pytest.raises(V.ContractViolation, match="items->products.product_id: unmatched"):
        build_order_features({**mini, "products": mini["products"].where("product_id <> 'pB'")})
    with pytest.raises(V.ContractViolation, match="eligible->items"):
        build_order_features({**mini, "items": mini["items"].where("order_id <> 'o2'")})


def test_build_checks_and_summary(mini):
    features = build_order_features(mini)
    V.enforce(V.feature_violations(features))
    assert Q.feature_summary(features).first().asDict() == {
        "rows": 3, "unique_order_id": 3, "late": 1, "on_time": 2, "eligible_orders_without_payment": 1,
    }
    report = Q.quality_summary(features, geography.geo_quality(mini["geolocation"])).first().asDict()
    assert report["orders_missing_customer_coordinates"] == 1
    assert report["orders_with_no_available_seller_customer_distance"] == 1
    assert report["raw_geolocation_rows_outside_brazil_envelope"] == 1
    assert report["zip_prefixes_without_valid_coordinates"] == 1
    gaps = {r["column_name"]: r["missing_values"] for r in Q.missing_by_column(features).collect()}
    assert set(gaps) == set(C.FEATURE_ROW) and gaps["approval_delay_hours"] == 1


def test_delay_ignores_the_session_zone(spark):
    stamps = spark.createDataFrame([("2018-03-11 01:30:00", "2018-03-11 03:30:00"), ("2018-03-12 01:00:00", "2018-03-10 00:00:00")], "a string, b string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = [r[0] for r in stamps.select(elapsed_seconds(*[F.col(c).cast("timestamp_ntz") for c in "ab"])).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == [7200.0, -176400.0]


def test_features_ignore_the_session_zone(spark, mini):
    expected = as_set(order_features(mini))
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert as_set(order_features(mini)) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cohort_needs_both_dates(mini):
    late = mini["orders"].withColumn("order_delivered_customer_date", F.lit(None).cast("timestamp_ntz"))
    assert eligible_orders(late).count() == 0


def points(spark, rows):
    return spark.createDataFrame(
        rows, "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double"
    )


def test_centroids(spark):
    frame = points(spark, [
        ("1", -23.0, -46.0), ("1", -21.0, -44.0), ("1", -23.0, -46.0),
        ("2", 42.184003, -8.723762), ("2", -23.5, -46.6), ("3", 42.184003, -8.723762),
        ("4", -34.0, -74.0), ("4", 6.0, -28.0),
    ])
    got = {r[0]: (r[1], r[2]) for r in geography.zip_centroids(frame).collect()}
    assert got == {"1": (-22.0, -45.0), "2": (-23.5, -46.6), "4": (-14.0, -51.0)}


def test_crowded_zip_has_the_built_in_median(spark):
    crowd = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 200).cast("string")).alias("geolocation_zip_code_prefix"),
        (F.lit(-30.0) + (F.col("id") * 7919 % 2500) / 100).alias("geolocation_lat"),
        (F.lit(-70.0) + (F.col("id") * 104729 % 3900) / 100).alias("geolocation_lng"),
    )
    sliced = sorted(geography.zip_centroids(crowd).collect())
    built_in = sorted(crowd.distinct().groupBy("geolocation_zip_code_prefix").agg(
        F.median("geolocation_lat"), F.median("geolocation_lng")
    ).collect())
    assert len(sliced) == len(built_in) > 100
    for x, y in zip(sliced, built_in):
        assert x[0] == y[0] and x[1] == pytest.approx(y[1], abs=1e-9) and x[2] == pytest.approx(y[2], abs=1e-9)


def test_haversine(spark):
    pair = spark.range(1).select(
        haversine_km(*[F.lit(v) for v in (0.0, 0.0, 0.0, 180.0)]).alias("far"),
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(None).cast("double"), F.lit(1.0)).alias("unknown"),
    ).first()
    assert pair["far"] == pytest.approx(math.pi * C.EARTH_RADIUS_KM) and pair["unknown"] is None


def test_seller_pairs_are_distinct(mini):
    lines = I.enrich_items(mini["items"], mini["products"], mini["translations"], mini["sellers"])
    assert I.seller_pairs(lines.unionByName(lines)).count() == 5


def test_totals_are_rounded_once(spark):
    rows = [("o1", k, "voucher", 1, 0.005) for k in range(3)]
    frame = spark.createDataFrame(rows, "order_id string, payment_sequential long, payment_type string, payment_installments long, payment_value double")
    assert payment_rollup(frame).first()["payment_value_total"] == 0.02
