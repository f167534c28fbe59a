import random
from datetime import datetime, timedelta

import pytest

from parceltide.operators import evaluate as E
from parceltide.operators.validate import ContractViolation, check_split, enforce
from pyspark.sql import functions as F

SCORED = "order_id string, delay_flag int, risk_score double"


def hourly(spark, n, key="long"):
    start = datetime(2020, 1, 1)
    rows = [(f"order-{i:03d}", start + timedelta(hours=i), i % 2) for i in range(n)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "order_id string, order_purchase_timestamp timestamp_ntz, delay_flag int")


def random_scores(n, seed=3, levels=12):
    rng = random.Random(seed)
    return [(f"k{i:04d}", int(rng.random() < 0.3), rng.randint(0, levels) / levels) for i in range(n)]


def test_split_is_chronological(spark):
    split = E.chronological_split(hourly(spark, 20))
    rows = sorted((r["order_purchase_timestamp"], r["split"]) for r in split.collect())
    assert [s for _, s in rows] == ["train"] * 14 + ["validation"] * 3 + ["test"] * 3
    check_split(E.split_summary(split))


@pytest.mark.parametrize("missing, kinds", [(4, "test"), (8, "late validation and test")])
def test_split_puts_missing_times_last(spark, missing, kinds):
    frame = hourly(spark, 20).withColumn(
        "order_purchase_timestamp", F.when(F.col("order_id") < f"order-{20 - missing:03d}", F.col("order_purchase_timestamp"))
    )
    split = {r["order_id"]: r["split"] for r in E.chronological_split(frame).collect()}
    assert [split[f"order-{i:03d}"] for i in range(20)] == ["train"] * 14 + ["validation"] * 3 + ["test"] * 3


def test_split_of_one_crowded_second(spark):
    stamp = datetime(2020, 1, 1)
    frame = spark.createDataFrame([(f"{i:03d}", stamp, i % 2) for i in range(200)],
                                  "order_id string, order_purchase_timestamp timestamp_ntz, delay_flag int")
    counts = {r["split"]: (r["n"], r["lo"]) for r in E.chronological_split(frame).groupBy("split").agg(
        F.count("*").alias("n"), F.min("order_id").alias("lo")).collect()}
    assert counts == {"train": (140, "000"), "validation": (30, "140"), "test": (30, "170")}


def test_split_needs_rows_and_classes(spark):
    with pytest.raises(ContractViolation):
        E.chronological_split(hourly(spark, 2))
    single = E.chronological_split(hourly(spark, 20).withColumn("delay_flag", F.lit(0)))
    with pytest.raises(ContractViolation, match="both target classes"):
        check_split(E.split_summary(single))


def test_threshold_example(spark):
    frame = spark.createDataFrame([("a", 0, 0.1), ("b", 1, 0.6), ("c", 1, 0.8), ("d", 0, 0.5)], SCORED)
    assert E.select_threshold(E.score_curve(frame)).first()["threshold"] == 0.6


def test_threshold_without_positives_is_one(spark):
    frame = spark.createDataFrame([("a", 0, 0.1), ("b", 0, 0.6)], SCORED)
    row = E.select_threshold(E.score_curve(frame)).first()
    assert (row["threshold"], row["f1"]) == (1.0, 0.0)


def test_threshold_against_brute_force(spark):
    rows = random_scores(300)
    best = (-1.0, -1.0, -1.0)
    for t in sorted({0.0, 1.0, *[s for _, _, s in rows]}):
        tp = sum(y for _, y, s in rows if s >= t)
        hit, late = sum(s >= t for _, _, s in rows), sum(y for _, y, _ in rows)
        best = max(best, (2 * tp / (hit + late), tp / hit if hit else 0.0, t))
    row = E.select_threshold(E.score_curve(spark.createDataFrame(rows, SCORED))).first()
    assert (row["f1"], row["precision"], row["threshold"]) == pytest.approx(best)


def test_discrimination_against_brute_force(spark):
    rows = random_scores(300, seed=9)
    pos = [s for _, y, s in rows if y]
    neg = [s for _, y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, previous = 0.0, 0.0
    for t in sorted({s for _, _, s in rows}, reverse=True):
        hits = [y for _, y, s in rows if s >= t]
        recall = sum(hits) / len(pos)
        ap += (recall - previous) * sum(hits) / len(hits)
        previous = recall
    row = E.discrimination(E.score_curve(spark.createDataFrame(rows, SCORED))).first()
    assert (row["roc_auc"], row["average_precision"]) == pytest.approx((auc, ap))


def test_discrimination_with_one_class_is_null(spark):
    row = E.discrimination(E.score_curve(spark.createDataFrame([("a", 1, 0.2), ("b", 1, 0.4)], SCORED))).first()
    assert row["roc_auc"] is None and row["average_precision"] == 1.0


def test_threshold_metrics_divide_by_zero(spark):
    row = E.threshold_metrics(spark.createDataFrame([("a", 0, 0.2)], SCORED), 0.5).first()
    assert (row["precision"], row["recall"], row["f1"], row["true_negatives"]) == (0.0, 0.0, 0.0, 1)
    exact = E.threshold_metrics(spark.createDataFrame([("a", 0, 0.1), ("b", 1, 0.9)], SCORED), 0.9).first()
    assert exact["f1"] == 1.0  # the threshold is inclusive


def test_topk_tie_goes_to_the_smaller_key(spark):
    frame = spark.createDataFrame([("b", 1, 0.9), ("a", 0, 0.9), ("c", 1, 0.8), ("d", 0, 0.1)], SCORED)
    rows = {r["cut"]: r for r in E.topk_metrics(frame).collect()}
    assert set(rows) == {"top_5_percent", "top_10_percent", "top_20_percent"}
    assert (rows["top_5_percent"]["selected_count"], rows["top_5_percent"]["late_orders_found"]) == (1, 0)


def test_topk_ties_follow_the_text_of_number_keys(spark):
    rows = [(10, 1, 0.9), (9, 0, 0.9), *((100 + i, 0, 0.1) for i in range(18))]
    found = E.topk_metrics(spark.createDataFrame(rows, SCORED.replace("order_id string", "order_id long"))).collect()
    assert {r["cut"]: r["late_orders_found"] for r in found}["top_5_percent"] == 1  # "10" sorts before "9"


@pytest.mark.parametrize("levels", [1, 12, 10_000])
def test_topk_against_brute_force(spark, levels):
    rows = random_scores(400, seed=levels, levels=levels)
    ordered = sorted(rows, key=lambda r: (-r[2], r[0]))
    late = sum(y for _, y, _ in rows)
    for r in E.topk_metrics(spark.createDataFrame(rows, SCORED)).collect():
        k = r["selected_count"]
        found = sum(y for _, y, _ in ordered[:k])
        assert r["late_orders_found"] == found
        assert r["recall"] == pytest.approx(found / late)
        assert r["lift_over_prevalence"] == pytest.approx((found / k) / (late / len(rows)))


def test_candidate_selection(spark):
    rows = [("z", 0.4, 0.9), ("a", 0.4, 0.9), ("low", 0.3, 1.0)]
    frame = spark.createDataFrame(rows, "candidate string, average_precision double, roc_auc double")
    assert E.select_candidate(frame).first()["candidate"] == "a"


def test_bad_scores_are_rejected(spark):
    for bad in (float("nan"), float("inf"), -0.1, 1.1, None):
        with pytest.raises(ContractViolation):
            enforce(E.score_violations(spark.createDataFrame([("a", 0, bad)], SCORED)))


def test_baseline_scores(spark):
    split = E.chronological_split(hourly(spark, 20))
    rows = E.baseline_scores(split).collect()
    assert len(rows) == 3 and {r["risk_score"] for r in rows} == {0.5}


def test_class_weights(spark):
    row = E.class_weights(spark.createDataFrame([(0,), (0,), (0,), (1,)], "delay_flag int")).first()
    assert (row["on_time"], row["late"], row["scale_pos_weight"], row["weight_late"]) == (3, 1, 3.0, 2.0)
