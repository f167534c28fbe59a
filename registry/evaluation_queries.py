"""Queries over the split, the score curve and the score reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from parceltide import contracts as C
from parceltide.operators import evaluate as E, scoring as S
from registry.common import cohort, feature_table, register, scored
from registry.broken_sources import BROKEN_SCORE
from registry.views import compose

THRESHOLD = 0.6
NAME = "stand_in"


def _rounded(frame, *columns, places=9):
    return frame.select(*[F.round(c, places).alias(c) if c in columns else F.col(c) for c in frame.columns])


@register("chronological_split", compose("SELECT order_id, order_purchase_timestamp, split FROM split"))
def _(spark, folder):
    return E.chronological_split(cohort(spark, folder)).select("order_id", "order_purchase_timestamp", "split")


@register("split_summary", compose("""
SELECT split, count(*) AS rows, count(*) FILTER (WHERE delay_flag = 0) AS on_time, count(*) FILTER (WHERE delay_flag = 1) AS late,
  100.0::DOUBLE * count(*) FILTER (WHERE delay_flag = 0) / count(*) AS on_time_percentage,
  100.0::DOUBLE * count(*) FILTER (WHERE delay_flag = 1) / count(*) AS late_percentage,
  strftime(min(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS "start",
  strftime(max(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS "end"
FROM split GROUP BY split"""))
def _(spark, folder):
    return E.split_summary(E.chronological_split(cohort(spark, folder)))


@register("class_weights", compose("""
SELECT o AS on_time, l AS late, o::DOUBLE / l AS scale_pos_weight, (o + l)::DOUBLE / (2 * o) AS weight_on_time,
  (o + l)::DOUBLE / (2 * l) AS weight_late
FROM (SELECT count(*) FILTER (WHERE delay_flag = 0) AS o, count(*) FILTER (WHERE delay_flag = 1) AS l
  FROM split WHERE split = 'train')"""))
def _(spark, folder):
    split = E.chronological_split(cohort(spark, folder))
    return E.class_weights(split.where(F.col("split") == "train"))


_CONFUSION = """
SELECT tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
  coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0::DOUBLE) AS "precision",
  coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0::DOUBLE) AS recall,
  coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0.0::DOUBLE) AS f1, {t}::DOUBLE AS selected_threshold
FROM (SELECT count(*) FILTER (WHERE risk_score >= {t}::DOUBLE AND delay_flag = 1) AS tp,
  count(*) FILTER (WHERE risk_score >= {t}::DOUBLE AND delay_flag = 0) AS fp,
  count(*) FILTER (WHERE risk_score < {t}::DOUBLE AND delay_flag = 0) AS tn,
  count(*) FILTER (WHERE risk_score < {t}::DOUBLE AND delay_flag = 1) AS fn FROM {source})"""


@register("threshold_metrics", compose(_CONFUSION.format(t=THRESHOLD, source="scored")))
def _(spark, folder):
    return E.threshold_metrics(scored(spark, folder), THRESHOLD)


@register("baseline_metrics", compose(
    f"""SELECT c.*, round(r.roc_auc, 9) AS roc_auc, round(r.average_precision, 9) AS average_precision
FROM ({_CONFUSION.format(t=0.5, source='prior')}) c, (
  SELECT 0.5::DOUBLE AS roc_auc, avg(delay_flag::DOUBLE) AS average_precision FROM prior) r""",
    prior="""SELECT order_id, delay_flag, (SELECT avg(delay_flag::DOUBLE) FROM split WHERE split = 'train') AS risk_score
FROM split WHERE split = 'test'""",
))
def _(spark, folder):
    prior = E.baseline_scores(E.chronological_split(cohort(spark, folder)))
    both = E.discrimination(E.score_curve(prior)).select(F.struct("roc_auc", "average_precision"))
    report = E.threshold_metrics(prior, 0.5).withColumn("d", both.scalar())
    return _rounded(
        report.select(*[c for c in report.columns if c != "d"], "d.*"), "roc_auc", "average_precision"
    )


@register("score_curve", compose("SELECT risk_score AS score, n, pos, predicted, tp FROM curve"))
def _(spark, folder):
    return E.score_curve(scored(spark, folder))


@register("roc_auc", compose("""
SELECT round(sum(pos::HUGEINT * (2 * ((total - late) - (predicted - tp)) + (n - pos)))::DOUBLE
  / (2.0::DOUBLE * max(late) * max(total - late)), 9) AS roc_auc FROM curve"""))
def _(spark, folder):
    return _rounded(E.discrimination(E.score_curve(scored(spark, folder))), "roc_auc").select("roc_auc")


@register("average_precision", compose("""
SELECT round(sum(pos::DOUBLE / late * (tp::DOUBLE / predicted)), 9) AS average_precision FROM curve"""))
def _(spark, folder):
    report = E.discrimination(E.score_curve(scored(spark, folder)))
    return _rounded(report, "average_precision").select("average_precision")


@register("select_threshold", compose(
    """
SELECT threshold, f1, "precision" FROM (SELECT threshold, 2.0::DOUBLE * tp / (predicted + late) AS f1,
    coalesce(tp::DOUBLE / nullif(predicted, 0), 0.0::DOUBLE) AS "precision" FROM candidates)
ORDER BY f1 DESC, "precision" DESC, threshold DESC LIMIT 1""",
    candidates="""SELECT risk_score AS threshold, tp, predicted, late FROM curve
UNION ALL SELECT 0.0::DOUBLE, max(late), max(total), max(late) FROM curve
UNION ALL SELECT 1.0::DOUBLE, 0, 0, max(late) FROM curve""",
))
def _(spark, folder):
    return E.select_threshold(E.score_curve(scored(spark, folder)))


@register("topk_metrics", compose(
    """
SELECT cut, max(k) AS selected_count, sum(delay_flag)::BIGINT AS late_orders_found,
  sum(delay_flag)::DOUBLE / max(k) AS "precision", sum(delay_flag)::DOUBLE / max(late) AS recall,
  (sum(delay_flag)::DOUBLE / max(k)) / (max(late)::DOUBLE / max(n)) AS lift_over_prevalence
FROM ranked r JOIN (SELECT cut, greatest(1, ceil(n * f))::BIGINT AS k FROM (SELECT DISTINCT n FROM ranked),
    (VALUES ('top_5_percent', 0.05::DOUBLE), ('top_10_percent', 0.10::DOUBLE), ('top_20_percent', 0.20::DOUBLE)) v(cut, f)) c
  ON r.rn <= c.k GROUP BY cut""",
    ranked="""SELECT *, row_number() OVER (ORDER BY risk_score DESC, order_id::VARCHAR) AS rn, count(*) OVER () AS n,
  sum(delay_flag) OVER () AS late FROM scored""",
))
def _(spark, folder):
    report = E.topk_metrics(scored(spark, folder))
    return report.select(
        "cut", "selected_count", "late_orders_found", "precision", "recall", "lift_over_prevalence"
    )


_CANDIDATE_SCORES = {"alpha": 7919, "beta": 104729, "gamma": 7919}


@register("select_candidate", compose(
    """SELECT candidate, round(average_precision, 9) AS average_precision, round(roc_auc, 9) AS roc_auc FROM metrics
ORDER BY round(average_precision, 9) DESC, round(roc_auc, 9) DESC, candidate LIMIT 1""",
    per_score=" UNION ALL ".join(
        f"SELECT '{name}' AS candidate, ((order_id * {k}) % 1000) / 1000.0::DOUBLE AS s, count(*) AS n, "
        "sum(delay_flag)::BIGINT AS pos FROM cohort GROUP BY s"
        for name, k in _CANDIDATE_SCORES.items()
    ),
    curves="""SELECT *, sum(n) OVER w AS predicted, sum(pos) OVER w AS tp,
  sum(n) OVER (PARTITION BY candidate) AS total, sum(pos) OVER (PARTITION BY candidate) AS late
FROM per_score WINDOW w AS (PARTITION BY candidate ORDER BY s DESC)""",
    metrics="""SELECT candidate, sum(pos::DOUBLE / late * (tp::DOUBLE / predicted)) AS average_precision,
  sum(pos::HUGEINT * (2 * ((total - late) - (predicted - tp)) + (n - pos)))::DOUBLE
    / (2.0::DOUBLE * max(late) * max(total - late)) AS roc_auc
FROM curves GROUP BY candidate""",
))
def _(spark, folder):
    """Three stand-in candidates, two of them tied on both metrics."""
    rows = cohort(spark, folder)
    metrics = None
    for name, factor in _CANDIDATE_SCORES.items():
        scores = rows.select(
            "order_id", "delay_flag", ((F.col("order_id") * factor % 1000) / F.lit(1000.0)).alias("risk_score")
        )
        one = _rounded(E.discrimination(E.score_curve(scores)), "roc_auc", "average_precision").select(
            F.lit(name).alias("candidate"), "average_precision", "roc_auc"
        )
        metrics = one if metrics is None else metrics.unionByName(one)
    return E.select_candidate(metrics)


# -- decisions and reports ---------------------------------------------------

_DECIDED = {
    "decided": f"""SELECT order_id, risk_score, {THRESHOLD}::DOUBLE AS decision_threshold,
  risk_score >= {THRESHOLD}::DOUBLE AS predicted_delay, '{NAME}' AS model_name FROM scored""",
}


def _decided(spark, folder):
    return S.decisions(scored(spark, folder), THRESHOLD, NAME)


@register("score_decisions", compose("SELECT * FROM decided", **_DECIDED))
def _(spark, folder):
    return _decided(spark, folder)


@register("score_rules", compose("""
SELECT 'scores' AS "table", 'unit_interval' AS rule, 'risk_score' AS "column",
  count(*) FILTER (WHERE risk_score IS NULL OR NOT isfinite(risk_score) OR risk_score NOT BETWEEN 0 AND 1) AS violations
FROM b_scored""", b_scored=f"SELECT {BROKEN_SCORE} AS risk_score FROM scored"))
def _(spark, folder):
    return E.score_violations(scored(spark, folder).withColumn("risk_score", F.expr(BROKEN_SCORE)))


@register("score_search", compose(
    "SELECT * FROM decided WHERE contains(lower(order_id::VARCHAR), '17') AND predicted_delay", **_DECIDED
))
def _(spark, folder):
    return S.search_scores(_decided(spark, folder), " 17 ", "predicted")


@register("risk_report", compose(
    """
SELECT d.order_id, printf('%.2f%%', risk_score * 100) AS risk_text,
  CASE WHEN seller_customer_distance_km_max IS NULL THEN '—'
    ELSE printf('%.1f km', seller_customer_distance_km_max) END AS distance_text, predicted_delay
FROM decided d JOIN features f ON d.order_id = f.order_id""", **_DECIDED))
def _(spark, folder):
    distances = feature_table(spark, folder).select(C.ORDER_KEY, "seller_customer_distance_km_max")
    return S.risk_report(_decided(spark, folder).join(distances, C.ORDER_KEY))


@register("risk_counts", compose(
    """SELECT (SELECT count(*) FROM cohort) AS total_orders, count(*) AS scored_orders,
  count(*) FILTER (WHERE predicted_delay) AS predicted_delays FROM decided""", **_DECIDED))
def _(spark, folder):
    return S.risk_counts(cohort(spark, folder), _decided(spark, folder))
