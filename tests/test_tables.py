"""Rules, reconciliation, audits, sinks and scoring."""

import pytest

from parceltide import contracts as C, sinks, snapshots
from parceltide.operators import audit as A, reconcile as R, scoring as S, validate as V
from parceltide.plans.order_features import order_features
from parceltide.session import stage, staging_root
from parceltide.sources import tables
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def features(mini):
    return stage(order_features(mini), "features")


def counts(violations):
    return {(r["rule"], r["column"]): r["violations"] for r in violations.collect()}


def test_key_rules(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (2, 1)], "a int, b int")
    assert counts(V.key_violations(frame, ["a", "b"], "t")) == {("missing_key", "a,b"): 1, ("duplicate_key", "a,b"): 2}


def test_orphans_count_child_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert V.orphan_violations(child, parent, "k", "c->p").first()["violations"] == 3


def test_join_checked(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (3, "e")], "k int, x string")
    right = spark.createDataFrame([(1, "c"), (1, "d")], "k int, y string")
    with pytest.raises(Exception, match="dims: repeated key 1"):
        V.join_checked(left, right, "k", name="dims").collect()
    once = right.limit(1)
    assert sorted(r.x for r in V.join_checked(left, once, "k").collect()) == ["a", "b", "e"]
    with pytest.raises(Exception, match="repeated key"):
        V.join_checked(left, once, "k", cardinality="one_to_one").collect()
    assert sorted(V.join_checked(left.where("x <> 'b'"), once, "k", cardinality="one_to_one").collect())[0][1:] == ("a", once.first().y)
    assert V.join_checked(once, left, "k", cardinality="one_to_many").columns == ["k", "y", "x"]
    assert V.join_checked(once, left, "k", cardinality="one_to_many").count() == 2
    # a repeated key that nothing meets, and NULL keys, do no harm
    spare = spark.createDataFrame([(1, "c"), (9, "d"), (9, "e"), (None, "f"), (None, "g")], "k int, y string")
    assert len(V.join_checked(left, spare, "k").collect()) == 3
    assert len(V.join_checked(spark.createDataFrame([(None, "n")], "k int, x string"), spare, "k").collect()) == 1


def test_key_pass_reads_every_table_once(spark, mini):
    import re

    from conftest import ROWS
    from parceltide.session import stage

    stored = {n: stage(f, n) for n, f in mini.items()}
    rules = [*V.UNIQUE_RULES, *V.REFERENCE_RULES, V.assignment_rule(), V.itemless_rule()]
    found = V.key_rule_violations(stored, rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == len([n for n in ROWS if n != "geolocation"])
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Join" not in plan
    rows = {(r.table, r.rule): r.violations for r in found.collect()}
    assert not any(rows.values()) and len(rows) == 2 * (len(V.UNIQUE_RULES) + 1) + len(V.REFERENCE_RULES) + 1


def test_key_parts_are_not_mistaken(spark):
    frame = spark.createDataFrame([("1:a", "b"), ("1", "a:b"), ("", "x"), ("x", "")], "a string, b string")
    assert set(counts(V.key_violations(frame, ["a", "b"], "t")).values()) == {0}
    child = spark.createDataFrame([("7",), ("07",)], "k string")  # compared as the parent's whole numbers
    parent = spark.createDataFrame([(7,)], "k int")
    assert V.orphan_violations(child, parent, "k", "c->p").first()["violations"] == 0
    assert counts(V.key_violations(frame.limit(0), ["a", "b"], "t")) == {("missing_key", "a,b"): 0, ("duplicate_key", "a,b"): 0}


def test_missing_sources_and_columns(mini):
    with pytest.raises(V.ContractViolation, match="missing sources"):
        V.require_sources({k: v for k, v in mini.items() if k != "items"})
    with pytest.raises(V.ContractViolation, match="price"):
        V.require_sources({**mini, "items": mini["items"].drop("price")})


def test_shared_customer_is_reported(mini):
    shared = {**mini, "orders": mini["orders"].withColumn("customer_id", F.lit("c1"))}
    assert counts(V.customer_assignment_violations(shared))[("duplicate_key", "customer_id")] == 4


def test_feature_contract(features):
    V.check_feature_layout(features)
    with pytest.raises(V.ContractViolation):
        V.check_feature_layout(features.select(*reversed(features.columns)))
    bad = features.withColumn("delay_flag", F.lit(2))
    assert counts(V.feature_violations(bad.unionByName(bad)))[("binary", "delay_flag")] == 6
    with pytest.raises(V.ContractViolation, match="duplicate_key"):
        V.enforce(V.feature_violations(features.unionByName(features)))


def test_reconcile_rows_sees_lost_duplicates(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y")], "k int, v string")
    assert R.reconcile_rows(a, b, ["k", "v"]).first().asDict() == {
        "left_rows_missing_from_right": 1, "right_rows_missing_from_left": 1,
        "left_surplus_copies": 2, "right_surplus_copies": 1,
    }
    same = R.reconcile_rows(a, a, ["k", "v"]).first()
    assert set(same.asDict().values()) == {0}


def test_reconcile_keyed(spark):
    layout = "k int, f double, s string"
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y"), (3, None, None), (4, 4.0, "z")], layout)
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, 2.5, "w"), (3, 3.0, None), (5, 5.0, "q")], layout)
    rows = {r["column_name"]: (r["mismatches"], r["max_abs_difference"]) for r in R.reconcile_keyed(a, b, "k", a.columns).collect()}
    assert rows == {"<only in left>": (1, None), "<only in right>": (1, None), "f": (2, 0.5), "s": (1, None)}


def test_repeated_keys_are_compared_once(spark):
    layout = "k int, f double, s string"
    a = spark.createDataFrame([(1, 1.0, "x")] * 100 + [(2, 1.0, "x")], layout)
    b = spark.createDataFrame([(1, 2.0, "x")] * 100 + [(2, 1.0, "x")], layout)
    rows = {r["column_name"]: r["mismatches"] for r in R.reconcile_keyed(a, b, "k", a.columns).collect()}
    assert rows == {"<only in left>": 0, "<only in right>": 0, "f": 1, "s": 0}


def test_schema_diff(spark, features):
    expected = tables.expected_inventory(spark)
    actual = tables.schema_inventory(features)
    assert R.schema_diff(expected, actual).count() == 0
    swapped = features.select(*C.FEATURE_ROW[1:], C.FEATURE_ROW[0])
    assert R.schema_diff(expected, tables.schema_inventory(swapped)).count() == 66


def test_sinks(spark, features, tmp_path):
    path = str(tmp_path / "once")
    sinks.write_features(features, path)
    with pytest.raises(Exception):
        sinks.write_features(features, path)
    assert tables.load_features(spark, path).count() == 3
    nested = str(tmp_path / "a" / "b")
    sinks.replace_features(features, nested)
    sinks.replace_features(features, nested)
    stamps = [r[0] for r in spark.read.parquet(nested).select(C.PURCHASE_TIME).collect()]
    assert stamps == sorted(stamps) and len(stamps) == 3


def test_load_features_rejects(spark, features, tmp_path):
    for name, frame, message in (
        ("column", features.drop("purchase_hour"), "purchase_hour"),
        ("twice", features.unionByName(features), "duplicate_key"),
        ("target", features.withColumn("delay_flag", F.lit(None).cast("int")), "delay_flag"),
    ):
        path = str(tmp_path / name)
        frame.write.parquet(path)
        with pytest.raises(ValueError, match=message):
            tables.load_features(spark, path)


@pytest.fixture
def snapshot(spark, tmp_path):
    snapshots.create_snapshot(spark, "snapshot_test", str(tmp_path / "snapshot"))
    yield "snapshot_test"
    spark.sql("DROP TABLE snapshot_test")


def prices(spark, table):
    return sorted((r["order_id"], r["item_price_total"]) for r in spark.table(table).collect())


def test_snapshot_merge_is_insert_only(spark, features, snapshot):
    assert snapshots.merge_snapshot(features.where("order_id = 'o1'"), snapshot) == 1
    drifted = features.withColumn("item_price_total", F.lit(99.0))
    assert [snapshots.merge_snapshot(drifted, snapshot) for _ in range(2)] == [2, None]
    assert prices(spark, snapshot) == [("o1", 20.0), ("o2", 99.0), ("o3", 99.0)]
    with pytest.raises(V.ContractViolation, match="primary_payment_type"):
        snapshots.merge_snapshot(features.withColumn("primary_payment_type", F.lit(None).cast("string")), snapshot)
    with pytest.raises(V.ContractViolation, match="duplicate_key"):
        snapshots.merge_snapshot(features.unionByName(drifted), snapshot)
    assert snapshots.published_versions(spark, snapshot) == {1, 2}


def test_two_merges_at_once_insert_no_order_twice(spark, features, snapshot, monkeypatch):
    plain = snapshots.publish
    others = [features.where("order_id = 'o1'").withColumn("item_price_total", F.lit(1.0)), features.where("order_id = 'o2'")]

    def late(*args):  # twice another merge gets in between the write and the publishing
        if others:
            other = others.pop(0)
            monkeypatch.setattr(snapshots, "publish", plain)
            assert snapshots.merge_snapshot(other, snapshot) is not None
            monkeypatch.setattr(snapshots, "publish", late)
        return plain(*args)

    monkeypatch.setattr(snapshots, "publish", late)
    assert snapshots.merge_snapshot(features, snapshot) == 3
    got = prices(spark, snapshot)
    assert [k for k, _ in got] == ["o1", "o2", "o3"] and got[0] == ("o1", 1.0)


def test_merge_lost_between_write_and_publishing(spark, features, snapshot, monkeypatch):
    plain = snapshots.publish

    def lost(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "publish", lost)
    with pytest.raises(KeyboardInterrupt):
        snapshots.merge_snapshot(features, snapshot)
    assert spark.table(snapshot).count() == 0  # what was written is not seen
    monkeypatch.setattr(snapshots, "publish", plain)
    assert snapshots.merge_snapshot(features, snapshot) == 1
    assert [k for k, _ in prices(spark, snapshot)] == ["o1", "o2", "o3"]


class FakeSession:
    """Only what ``staging_root`` reads."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master, self.applicationId = master, f"test-{master}"

    def getCheckpointDir(self):
        return None


def test_staging_folder(spark):
    assert staging_root(FakeSession("hdfs://shared/dir/", "yarn")) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(FakeSession(None, "spark://host:7077"))
    made = staging_root(FakeSession(None, "local[2]"))
    assert made == staging_root(FakeSession(None, "local[2]")) and "parceltide" in made
    stored = stage(spark.range(5), "numbers")
    assert staging_root(spark) in stored.inputFiles()[0] and stored.count() == 5


def test_audits(mini):
    profile = A.table_profile(mini["geolocation"], "geolocation", C.USED_COLUMNS["geolocation"]).first()
    assert (profile["row_count"], profile["distinct_keys"], profile["duplicate_groups"],
            profile["rows_in_duplicate_groups"], profile["occurrences_beyond_first"]) == (5, 4, 1, 2, 1)
    assert A.sequence_audit(mini["items"], "order_id", "order_item_id").first().asDict() == {
        "continuous_groups": 4, "broken_groups": 0}
    gap = mini["items"].where("NOT (order_id = 'o1' AND order_item_id = 1)")
    assert A.sequence_audit(gap, "order_id", "order_item_id").first()["broken_groups"] == 1
    coverage = {r["relation"]: (r["keys_found"], r["keys_missing"], r["keys_unused"]) for r in A.coverage_audit(mini).collect()}
    assert coverage["customers->geolocation"] == (2, 1, 1)
    assert coverage["products->translations"] == (2, 0, 0)
    zips = A.zip_format(mini["customers"], "customers", "customer_zip_code_prefix").first()
    assert (zips["five_digit_rows"], zips["leading_zero_rows"], zips["leading_zero_prefixes"]) == (4, 3, 2)
    odd = A.order_anomalies(mini["orders"]).first().asDict()
    assert odd["missing_approval"] == 2 and odd["delivered_without_date"] == 0


# -- scoring -----------------------------------------------------------------

@pytest.fixture(scope="module")
def request_row(features):
    return features.where("order_id = 'o1'").drop(C.PURCHASE_TIME, C.TARGET)


def reasons(frame):
    return S.judge_requests(frame).first()["reasons"]


def test_valid_request_with_six_nulls(request_row):
    assert reasons(request_row) == []
    empty = request_row.select(*[
        F.lit(None).cast("double").alias(c) if c in C.NULLABLE_FEATURES else F.col(c) for c in request_row.columns
    ])
    assert reasons(empty) == []
    assert reasons(request_row.withColumn("primary_product_category", F.lit("never seen"))) == []


@pytest.mark.parametrize("column", [c for c in C.MODEL_FEATURES if c not in C.NULLABLE_FEATURES][::4])
def test_required_feature_missing(request_row, column):
    kind = dict(request_row.dtypes)[column]
    assert f"{column}:required" in reasons(request_row.withColumn(column, F.lit(None).cast(kind)))


@pytest.mark.parametrize("column, value, reason", [
    ("purchase_year", 2015, "purchase_year:range"), ("purchase_month", 13, "purchase_month:range"),
    ("purchase_day_of_week", 7, "purchase_day_of_week:range"), ("purchase_hour", -1, "purchase_hour:range"),
    ("item_row_count", 0, "item_row_count:range"), ("freight_value_total", -0.5, "freight_value_total:range"),
    ("approval_delay_hours", float("nan"), "approval_delay_hours:finite"),
    ("item_price_total", float("inf"), "item_price_total:finite"),
    ("customer_state", "sp", "customer_state:pattern"), ("customer_state", "SP\n", "customer_state:pattern"),
    ("primary_payment_type", "", "primary_payment_type:empty"),
])
def test_rule_violations(request_row, column, value, reason):
    kind = dict(request_row.dtypes)[column]
    assert reason in reasons(request_row.withColumn(column, F.lit(value).cast(kind)))


def test_request_columns(request_row):
    for wrong in (request_row.withColumn("extra", F.lit(1)), request_row.drop("purchase_hour"),
                  request_row.withColumn("payment_data_missing", F.lit(1))):
        with pytest.raises(ValueError):
            S.judge_requests(wrong)
    assert reasons(request_row.drop("order_id")) == []


def test_invalid_score_fails_the_job(spark):
    for bad in (float("nan"), 1.5, None):
        scored = spark.createDataFrame([("a", bad)], "order_id string, risk_score double")
        with pytest.raises(Exception, match="invalid risk score"):
            S.decisions(scored, 0.5, "m").collect()


def test_decisions_search_and_report(spark):
    scored = spark.createDataFrame(
        [("Ab-2", 0.5, 12.34), ("ab-1", 0.5, None), ("x", 0.49, 1.0)],
        "order_id string, risk_score double, seller_customer_distance_km_max double",
    )
    decided = S.decisions(scored, 0.5, "m")
    assert {r["order_id"]: r["predicted_delay"] for r in decided.collect()} == {"Ab-2": True, "ab-1": True, "x": False}
    assert S.search_scores(decided, "  AB ").count() == 2
    assert S.search_scores(decided, "", "notPredicted").count() == 1
    joined = decided.join(scored.drop("risk_score"), "order_id")
    assert [tuple(r) for r in S.risk_report(joined).collect()] == [
        ("Ab-2", "50.00%", "12.3 km", True), ("ab-1", "50.00%", "—", True), ("x", "49.00%", "1.0 km", False)]
    assert S.risk_counts(scored, decided).first().asDict() == {
        "scored_orders": 3, "predicted_delays": 2, "total_orders": 3}


def test_report_texts_round_like_printf(spark):
    from parceltide.functions.display import distance_text, percent_text

    values = [0.25, 12.35, 0.35, 1234.25, 1234.75, 0.0, 99.95, 1e7 + 0.05]
    rows = spark.createDataFrame([(v, v / 100) for v in values], "km double, share double")
    got = rows.select(distance_text(F.col("km")).alias("km"), percent_text(F.col("share")).alias("share"), (F.col("share") * 100).alias("p")).collect()
    assert [r.km for r in got] == [f"{v:.1f} km" for v in values]
    assert [r.share for r in got] == [f"{r.p:.2f}%" for r in got]


# -- repeated keys, order of files, raw requests


def test_copies_of_a_key_are_compared_as_multisets(spark):
    def differing(left, right):
        make = lambda rows: spark.createDataFrame(rows, "k int, v double, s string")
        found = R.reconcile_keyed(make(left), make(right), "k", ("k", "v", "s"))
        return {r.column_name: r.mismatches for r in found.collect()}

    one, two = (1, 5.0, "a"), (1, 1.0, "b")
    assert set(differing([one, two], [two, one]).values()) == {0}
    assert differing([one, two], [one, (1, 2.0, "b")]) == {"<only in left>": 0, "<only in right>": 0, "v": 1, "s": 0}
    assert differing([one, one, two], [one, two, two])["v"] == 1  # another number of copies of the same rows
    assert differing([one, one], [one])["s"] == 1
    assert differing([(1, None, "a"), (1, 0.0, "a")], [(1, 0.0, "a"), (1, 0.0, "a")])["v"] == 1
    assert differing([(2, 1.0, "x")], [(2, 1.0 + 1e-12, "x")])["v"] == 0  # single rows keep their tolerance
    assert differing([(None, 1.0, "x")], [(None, 2.0, "x")])["v"] == 1
    assert differing([one, one], [(3, 1.0, "c")]) == {"<only in left>": 1, "<only in right>": 1, "v": 0, "s": 0}


def test_order_is_proved_from_the_files(spark, tmp_path):
    order = ("t", "k")
    rows = spark.range(1000).select((F.col("id") % 50).alias("t"), F.col("id").alias("k"))
    good, within, between = (str(tmp_path / n) for n in ("good", "within", "between"))
    rows.orderBy("t", "k").write.parquet(good)
    found = sinks.order_check(spark, good, order).first()
    assert (found.n_rows, found.inversions_within, found.inversions_between) == (1000, 0, 0)
    assert (found.first_t, found.first_k, found.last_t, found.last_k) == (0, 0, 49, 999)
    rows.coalesce(1).write.parquet(within)
    assert sinks.order_check(spark, within, order).first().inversions_within == 19
    rows.repartitionByRange(4, F.col("t").desc()).sortWithinPartitions("t", "k").write.parquet(between)
    found = sinks.order_check(spark, between, order).first()
    assert found.inversions_within == 0 and found.inversions_between == 3
    assert sum(r.n for r in sinks.file_bounds(spark, between, order).collect()) == 1000


def test_every_request_is_read_on_its_own(spark, features):
    import json

    row = features.where("order_id = 'o1'").first().asDict()
    good = {c: row[c] for c in C.MODEL_FEATURES} | {"order_id": "o1"}
    dropped = {k: v for k, v in good.items() if k != "approval_delay_hours"}
    cases = {
        "good": (good, []),
        "no id": ({k: v for k, v in good.items() if k != "order_id"}, []),
        "as text": ({**good, "item_row_count": "2", "purchase_hour": 10.0}, []),
        "null gap": ({**good, "approval_delay_hours": None}, []),
        "missing": (dropped, ["approval_delay_hours:missing"]),
        "extra": ({**good, "zeta": 1, "alpha": None}, ["alpha:extra", "zeta:extra"]),
        "flag": ({**good, "payment_data_missing": 1}, ["payment_data_missing:type"]),
        "fraction": ({**good, "item_row_count": 1.5}, ["item_row_count:type"]),
        "word": ({**good, "item_price_total": "many", "customer_state": 7}, ["customer_state:type", "item_price_total:type"]),
        "nested": ({**good, "purchase_month": [1], "order_id": {}}, ["order_id:type", "purchase_month:type"]),
        "null": ({**good, "item_row_count": None}, ["item_row_count:required"]),
        "range": ({**good, "purchase_month": 13}, ["purchase_month:range"]),
    }
    bodies = [(n, json.dumps(b)) for n, (b, _) in cases.items()]
    bodies += [("cut", "{\"a\":"), ("list", "[1]"), ("none", None), ("empty", ""), ("text", "\"x\"")]
    frame = spark.createDataFrame(bodies, "name string, body string")
    got = {r.name: (r.valid, r.reasons) for r in S.judge_bodies(frame).collect()}
    for name, (_, reasons) in cases.items():
        assert got[name] == (not reasons, reasons), name
    assert all(got[n] == (False, ["body:json"]) for n in ("cut", "list", "none", "empty", "text"))
    typed = {r.name: r for r in S.read_requests(frame).collect()}
    assert typed["as text"].item_row_count == 2 and typed["as text"].purchase_hour == 10
    assert typed["good"].item_price_total == row["item_price_total"] and typed["good"].order_id == "o1"
    assert dict(S.read_requests(frame).dtypes)["item_row_count"] == C.FEATURE_TYPES["item_row_count"]
