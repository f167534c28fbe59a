"""Plan shape: what a large cluster would run."""

import re

import pytest

from parceltide.plans.order_features import order_features
from parceltide.session import stage
from parceltide.sources.retail_views import retail_sources
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    changed = {}

    def put(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_items_are_exchanged_once(spark, settings):
    # Facts above the broadcast limit, stored dimensions below it.
    settings(spark__sql__autoBroadcastJoinThreshold="200000")
    plan = plan_of(order_features(retail_sources(spark, FOLDER)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by_order = [e for e in exchanges if e.startswith("order_id")]
    # items, orders, payment subtotals, payment totals
    assert len(by_order) == 4, exchanges
    assert not any("product_id" in e or "seller_id" in e for e in exchanges)
    assert "Window" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = plan_of(order_features(retail_sources(spark, FOLDER)))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    items = next(s for s in scans if "l_orderkey" in s)
    assert "l_shipdate" not in items and "l_discount" not in items and "l_linenumber" not in items


@pytest.mark.parametrize("dimension_limit", ["100000", "10000"])
def test_hot_order_is_split(spark, settings, dimension_limit):
    """One order owns half of the items; the join splits it and the result stays exact."""
    sources = retail_sources(spark, FOLDER)
    items = sources["items"].drop("order_item_id")
    hot = items.withColumn("order_id", F.lit(7).cast("bigint"))
    sources["items"] = stage(items.unionByName(hot), "hot-items")
    settings(
        spark__sql__autoBroadcastJoinThreshold=dimension_limit,
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    frame = order_features(sources)
    rows = {r["order_id"]: r for r in frame.collect()}
    assert "SortMergeJoin(skew=true)" in plan_of(frame)
    expected = sources["items"].where("order_id = 7").agg(
        F.count("*"), F.count_distinct("product_id"), F.count_distinct("seller_id"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double"),
    ).first()
    got = rows[7]
    assert tuple(expected) == (
        got["item_row_count"], got["distinct_product_count"], got["distinct_seller_count"], got["item_price_total"]
    )


def test_facets_reuse_the_order_partitioning_without_broadcasts(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(order_features(retail_sources(spark, FOLDER)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # the items by product, by seller and by order; no exchange on the facets of an order
    assert len([e for e in exchanges if e.startswith("order_id")]) == 4, exchanges
    assert not any("facet" in e for e in exchanges)


def test_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    from parceltide import session

    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in range(3):
        (tmp_path / f"{k}.parquet").write_bytes(bytes(1000))
    paths = [str(tmp_path / f"{k}.parquet") for k in range(3)]
    try:
        few = int(before[keys[0]])
        assert session.bound_tasks(spark, paths) == few  # small inputs keep the number
        monkeypatch.setattr(session, "PARTITION_INPUT", 10)
        assert session.bound_tasks(spark, paths) == 300 and spark.conf.get(keys[0]) == "300"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_facets_of_the_build_are_not_sorted(spark, settings):
    """A stored seller has one state, so its facets hold numbers beside their keys and are hashed."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(order_features(retail_sources(spark, FOLDER)))
    assert not re.findall(r"Sort \[[^\]]*facet", plan) and re.findall(r"HashAggregate\(keys=\[order_id[^\]]*facet", plan)


def test_key_entries_need_no_array_functions(spark):
    from parceltide.operators.validate import KeyRule, key_rule_violations

    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "c"), (3, None)], "k int, v string")
    found = key_rule_violations({"t": rows}, [
        KeyRule("all", "t", ("k",)), KeyRule("some", "t", ("v",), where=F.col("k") == 1), KeyRule("ref", "t", ("v",), ("t", ("v",)), F.col("k") == 3),
    ])
    assert "filter(" not in plan_of(found) and "lambda" not in plan_of(found)
    counts = {(r["table"], r["rule"]): r["violations"] for r in found.collect()}
    assert counts == {
        ("all", "missing_key"): 1, ("all", "duplicate_key"): 2, ("some", "missing_key"): 0, ("some", "duplicate_key"): 0, ("ref", "unmatched"): 1,
    }


def test_hashed_facets_equal_sorted_ones(spark):
    from parceltide.operators.items import facet_subtotals, facet_totals

    kinds = (
        "order_id long, product_id long, seller_id string, seller_state string, normalized_product_category string, price double, "
        "freight_value double, product_measurement_missing boolean, product_category_fallback boolean, product_weight_g double, "
        "product_volume_cm3 double"
    )
    lines = spark.createDataFrame([
        (1, 1, "a", "SP", "x", 10.0, 1.0, False, True, 5.0, 2.0), (1, 1, "a", "SP", "x", 0.005, 1.0, False, False, 5.0, None),
        (1, 2, "b", None, "y", 10.005, 0.5, True, False, 1.0, 2.0), (2, None, None, None, None, 3.0, 0.0, True, True, None, None),
        (2, 4, "c", "RJ", None, 3.0, 0.0, False, False, 1.0, 1.0), (3, 4, "b", None, "x", None, None, False, False, None, 1.0),
        (None, 4, "c", "RJ", "x", 1.0, 2.0, None, None, 1.0, 1.0),
    ], kinds)
    rows = [
        {tuple(r) for r in facet_subtotals(lines, one_state=known).groupBy("order_id").agg(*facet_totals()).collect()}
        for known in (False, True)
    ]
    assert rows[0] == rows[1] and len(rows[0]) == 4
    assert (1, 3, 2, 2, 20.01, 2.5, 1, 1, 11.0, None, "x", "SP") in rows[1]


def test_rollup_moves_lines_before_they_fan_out(spark, settings):
    from parceltide.operators.items import enrich_items, item_rollup

    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    src = retail_sources(spark, FOLDER)
    plan = plan_of(item_rollup(enrich_items(src["items"], src["products"], src["translations"], src["sellers"])))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and not any("facet" in e for e in exchanges), exchanges
    # the orders of the lines, the lines; totals are combined where the lines are
    assert len([e for e in exchanges if e.startswith("order_id")]) == 2, exchanges
    assert len(re.findall(r"Sort \[[^\]]*facet", plan)) == 1


def test_split_amounts_are_exact(spark):
    from parceltide.functions import money

    amounts = [0.1, 0.2, 84197.04, -0.01, -7.005, 1e9, 123456789012.34, 0.005, 1e-10, -1e-11, 999999999.99, None, float("nan")]
    rows = spark.createDataFrame([(x,) for x in amounts], "x double")
    parts = money.split(F.col("x"))
    for r in rows.select(money.exact(F.col("x")).alias("want"), money.joined(*parts).alias("got")).collect():
        assert r.want == r.got
    sums = rows.agg(F.sum(parts[0]).alias("units"), F.sum(parts[1]).alias("rest"), F.sum(money.exact(F.col("x"))).alias("want"))
    got = sums.select("want", money.joined(F.col("units"), F.col("rest")).alias("got")).first()
    assert got.want == got.got
