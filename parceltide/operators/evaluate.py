"""Chronological split and score metrics, all tie-aware and exact.

Score metrics read one curve: a row per distinct score, highest first, with the
running counts of rows and late orders. Rows are combined per score before they
are ordered, so a constant score is a single row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C
from parceltide.functions.parsing import is_finite
from parceltide.operators.ranking import running_totals
from parceltide.operators.validate import ContractViolation, count_violations

SPLITS = ("train", "validation", "test")
_NO_DAY = "~"  # sorts after every date


# -- chronological split -----------------------------------------------------

def split_cuts(frame: DataFrame, fractions: Sequence[float] | None = None) -> list[tuple[datetime, Any]]:
    """(timestamp, key) of the first validation and the first test row.

    Rows are counted per calendar day, a bounded table; only the days holding a
    cut are ranked, on (timestamp, key), so a crowded day or second spreads out.
    Rows without a timestamp come last, as one day of their own.
    """
    train, validation = fractions or (C.TRAIN_FRACTION, C.VALIDATION_FRACTION)
    day = F.coalesce(F.to_date(C.PURCHASE_TIME).cast("string"), F.lit(_NO_DAY))
    days = frame.groupBy(day.alias("day")).agg(F.count("*").alias("n")).orderBy("day").collect()
    total = sum(r["n"] for r in days)
    if total < 3:
        raise ContractViolation("the split needs at least three rows")
    cuts = [int(total * train), int(total * (train + validation))]
    if cuts[0] == 0 or cuts[1] <= cuts[0] or cuts[1] >= total:
        raise ContractViolation("too few rows for the chronological split")

    at_cut, before = [], 0
    for r in days:
        at_cut += [(r["day"], cut - before + 1) for cut in cuts if before <= cut < before + r["n"]]
        before += r["n"]
    rows = frame.select(day.alias("day"), C.PURCHASE_TIME, C.ORDER_KEY, F.lit(1).alias("one")).where(
        F.col("day").isin([d for d, _ in at_cut])
    )
    ranked = running_totals(rows, [F.col(C.PURCHASE_TIME), F.col(C.ORDER_KEY)], {"rank": "one"}, within=["day"])
    is_cut = reduce(Column.__or__, [(F.col("day") == d) & (F.col("rank") == p) for d, p in at_cut])
    found = ranked.where(is_cut).orderBy("day", "rank").collect()  # two rows
    return [(r[C.PURCHASE_TIME], r[C.ORDER_KEY]) for r in found]


def chronological_split(frame: DataFrame, fractions: Sequence[float] | None = None) -> DataFrame:
    """Add ``split``; after the cuts are known this is a map over the rows. Missing times come last."""
    first_validation, first_test = split_cuts(frame, fractions)
    kinds = dict(frame.dtypes)

    def before(cut) -> Column:
        time, smaller = F.col(C.PURCHASE_TIME), F.col(C.ORDER_KEY) < F.lit(cut[1]).cast(kinds[C.ORDER_KEY])
        if cut[0] is None:
            return time.isNotNull() | smaller
        at = F.lit(cut[0].isoformat(sep=" ")).cast(kinds[C.PURCHASE_TIME])  # zone-free
        return F.coalesce((time < at) | ((time == at) & smaller), F.lit(False))

    return frame.withColumn(
        "split",
        F.when(before(first_validation), SPLITS[0]).when(before(first_test), SPLITS[1]).otherwise(SPLITS[2]),
    )


def split_summary(split: DataFrame) -> DataFrame:
    """Rows, class counts and shares, and the covered period of each split."""
    rows, late = F.count("*"), F.sum(F.col(C.TARGET).cast("bigint"))
    return split.groupBy("split").agg(
        rows.alias("rows"), (rows - late).alias("on_time"), late.alias("late"),
        (F.lit(100.0) * (rows - late) / rows).alias("on_time_percentage"),
        (F.lit(100.0) * late / rows).alias("late_percentage"),
        F.min(C.PURCHASE_TIME).cast("string").alias("start"),
        F.max(C.PURCHASE_TIME).cast("string").alias("end"),
    )


def class_weights(train: DataFrame) -> DataFrame:
    """Class counts, the negative/positive ratio and balanced class weights."""
    rows, late = F.count("*"), F.sum(F.col(C.TARGET).cast("bigint"))
    return train.agg(rows.alias("rows"), late.alias("late")).select(
        (F.col("rows") - F.col("late")).alias("on_time"), "late",
        F.try_divide((F.col("rows") - F.col("late")).cast("double"), F.col("late")).alias("scale_pos_weight"),
        F.try_divide(F.col("rows").cast("double"), 2 * (F.col("rows") - F.col("late"))).alias("weight_on_time"),
        F.try_divide(F.col("rows").cast("double"), 2 * F.col("late")).alias("weight_late"),
    )


# -- metrics -----------------------------------------------------------------

def score_violations(scored: DataFrame, score: str = "risk_score") -> DataFrame:
    """Scores that are missing, not finite or outside [0, 1]."""
    s = F.col(score)
    bad = s.isNull() | ~is_finite(s) | (s < 0) | (s > 1)
    return count_violations("scores", scored, [("unit_interval", score, bad)])


def score_curve(scored: DataFrame, score: str = "risk_score", label: str = C.TARGET) -> DataFrame:
    """(score, n, pos, predicted, tp): running counts from the highest score down."""
    by_score = scored.groupBy(F.col(score).alias("score")).agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )
    return running_totals(by_score, [F.col("score").desc()], {"predicted": "n", "tp": "pos"})


def _totals(curve: DataFrame) -> Column:
    """One-row lookup {total, late} as a scalar subquery."""
    return curve.agg(
        F.struct(F.max("predicted").alias("total"), F.max("tp").alias("late")).alias("t")
    ).scalar()


def threshold_metrics(scored: DataFrame, threshold: float, score: str = "risk_score", label: str = C.TARGET) -> DataFrame:
    """Confusion counts, precision, recall and F1 at an inclusive threshold; 0/0 is 0."""
    hit, late = F.col(score) >= F.lit(float(threshold)), F.col(label) == 1
    counts = scored.agg(
        F.count_if(hit & late).alias("true_positives"), F.count_if(hit & ~late).alias("false_positives"),
        F.count_if(~hit & ~late).alias("true_negatives"), F.count_if(~hit & late).alias("false_negatives"),
    )
    tp, fp, fn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives"))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    return counts.select(
        "*", share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"), F.lit(float(threshold)).alias("selected_threshold"),
    )


def discrimination(curve: DataFrame) -> DataFrame:
    """ROC-AUC with half credit for ties, and step-wise average precision.

    The AUC numerator is an exact decimal sum. Both are NULL without late
    orders, and the AUC also without on-time orders.
    """
    wide = lambda c: c.cast("decimal(19,0)")
    n, pos, tp, predicted = (F.col(c) for c in ("n", "pos", "tp", "predicted"))
    with_totals = curve.withColumn("t", _totals(curve))
    total, late = F.col("t.total"), F.col("t.late")
    negatives_below = (total - late) - (predicted - tp)
    twice_wins = wide(pos) * wide(2 * negatives_below + (n - pos))
    return with_totals.agg(
        F.try_divide(
            F.sum(twice_wins).cast("double"),
            F.lit(2.0) * F.max(late).cast("double") * F.max(total - late).cast("double"),
        ).alias("roc_auc"),
        F.sum(F.try_divide(pos.cast("double"), late) * (tp / predicted)).alias("average_precision"),
    )


def select_threshold(curve: DataFrame) -> DataFrame:
    """Threshold with the best (F1, precision, threshold) among the scores, 0 and 1."""
    t = curve.agg(F.max("predicted").alias("total"), F.max("tp").alias("late"))
    candidates = (
        curve.select(F.col("score").alias("threshold"), "tp", "predicted")
        # Everything is predicted at 0; nothing at 1 unless a score equals 1,
        # and then the curve row for 1 wins or ties.
        .unionByName(t.select(F.lit(0.0).alias("threshold"), F.col("late").alias("tp"), F.col("total").alias("predicted")))
        .unionByName(t.select(F.lit(1.0).alias("threshold"), F.lit(0).alias("tp"), F.lit(0).alias("predicted")))
        .withColumn("late", t.select("late").scalar())
    )
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    best = candidates.agg(F.max(F.struct(
        share(2 * F.col("tp"), F.col("predicted") + F.col("late")).alias("f1"),
        share(F.col("tp"), F.col("predicted")).alias("precision"),
        "threshold",
    )).alias("best"))
    return best.select("best.threshold", "best.f1", "best.precision")


def topk_metrics(
    scored: DataFrame, fractions: Sequence[float] = C.TOP_FRACTIONS,
    key: str = C.ORDER_KEY, score: str = "risk_score", label: str = C.TARGET,
) -> DataFrame:
    """Late orders found in the top fractions, ordered by score desc, key asc.

    The curve says which score each cut falls on; only rows tied on such a
    score are ranked by key.
    """
    curve = score_curve(scored, score, label)
    options = F.array(*[
        F.struct(F.lit(f"top_{int(f * 100)}_percent").alias("cut"), F.lit(float(f)).alias("fraction"))
        for f in fractions
    ])
    k = F.greatest(F.lit(1), F.ceil(F.col("t.total") * F.col("fraction"))).cast("bigint")
    cuts = (
        curve.withColumn("t", _totals(curve)).select("*", F.inline(options)).withColumn("k", k)
        .where((F.col("predicted") - F.col("n") < F.col("k")) & (F.col("k") <= F.col("predicted")))
        .select(
            "cut", "k", "score", F.col("t.total").alias("total"), F.col("t.late").alias("late"),
            (F.col("tp") - F.col("pos")).alias("found_above"),
            (F.col("k") - (F.col("predicted") - F.col("n"))).alias("ties_taken"),
        )
    )
    # One row per fraction: the broadcast side has len(fractions) rows.
    tied = scored.select(
        F.col(key).cast("string").alias("key"),  # ties are taken in text order
        F.col(score).alias("score"), F.col(label).cast("bigint").alias("late_row"),
        F.lit(1).alias("one"),
    ).join(F.broadcast(cuts.select("cut", "score")), "score")
    ranked = running_totals(
        tied, [F.col("key")], {"rank_in_tie": "one", "found_in_tie": "late_row"}, within=["cut"]
    )
    found = cuts.join(ranked.select("cut", "rank_in_tie", "found_in_tie"), "cut").where(
        F.col("rank_in_tie") == F.col("ties_taken")
    ).withColumn("found", F.col("found_above") + F.col("found_in_tie"))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    precision = F.col("found") / F.col("k")
    prevalence = F.col("late") / F.col("total")
    return found.select(
        "cut", F.col("k").alias("selected_count"), F.col("found").alias("late_orders_found"),
        precision.alias("precision"), share(F.col("found"), F.col("late")).alias("recall"),
        F.coalesce(F.try_divide(precision, prevalence), F.lit(0.0)).alias("lift_over_prevalence"),
    )


def baseline_scores(split: DataFrame) -> DataFrame:
    """Test rows scored with the late share of the training rows."""
    prior = split.where(F.col("split") == "train").agg(F.avg(F.col(C.TARGET).cast("double"))).scalar()
    return split.where(F.col("split") == "test").withColumn("risk_score", prior)


def select_candidate(metrics: DataFrame) -> DataFrame:
    """Best validation average precision, then ROC-AUC, then name. One row."""
    return metrics.orderBy(
        F.col("average_precision").desc(), F.col("roc_auc").desc(), F.col("candidate").asc()
    ).limit(1)
