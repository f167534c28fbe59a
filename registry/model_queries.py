"""Queries over preprocessing, model fits and batch scoring."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from parceltide import contracts as C
from parceltide.operators import evaluate as E, model as M
from parceltide.plans.training import compare_candidates, prepared_split, score_batch, train_baseline
from registry.common import feature_table, register
from registry.views import compose

_FITTED: dict[tuple, object] = {}


def _fit_once(spark, folder):
    """A fit function that fits each candidate once per application and folder.

    The split, the seed and so the model are the same in every query.
    """
    def fit(candidate: M.Candidate, train):
        key = (spark.sparkContext.applicationId, folder, candidate.name)
        if key not in _FITTED:
            _FITTED[key] = M.fit_candidate(candidate, train)
        return _FITTED[key]

    return fit


def _split(spark, folder):
    return E.chronological_split(feature_table(spark, folder))


_SPLIT_FEATURES = {"fs": "SELECT f.*, s.split FROM features f JOIN split s ON f.order_id = s.order_id"}
_NUMERIC = [c for c in C.NUMERIC_FEATURES]


@register("exact_medians", compose(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median FROM fs WHERE split = 'train'" for c in _NUMERIC
), **_SPLIT_FEATURES))
def _(spark, folder):
    train = _split(spark, folder).where(F.col("split") == "train")
    return M.exact_medians(train).select("feature", F.round("median", 6).alias("median"))


_GAPS = ("approval_delay_hours", "seller_customer_distance_km_mean", "product_weight_g_total")


@register("impute_median", compose(
    "SELECT order_id, " + ", ".join(
        f"round(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM fs WHERE split = 'train')), 6) AS {c}" for c in _GAPS
    ) + ", coalesce(customer_state, '__missing__') AS customer_state FROM fs", **_SPLIT_FEATURES))
def _(spark, folder):
    split = _split(spark, folder)
    medians = {
        r["feature"]: r["median"] for r in M.exact_medians(split.where(F.col("split") == "train"), _GAPS).collect()
    }
    filled = M.impute(split.select("order_id", *_GAPS, "customer_state"), medians)
    return filled.select("order_id", *[F.round(c, 6).alias(c) for c in _GAPS], "customer_state")


@register("standard_scale", compose(
    "SELECT order_id, " + ", ".join(
        f"round((coalesce({c}, m_{c}) - a_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, 6) AS {c}" for c in _GAPS
    ) + " FROM fs, stats", **_SPLIT_FEATURES,
    medians="SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in _GAPS) + " FROM fs WHERE split = 'train'",
    stats="SELECT " + ", ".join(
        f"max(m_{c}) AS m_{c}, avg(coalesce({c}, m_{c})) AS a_{c}, stddev_pop(coalesce({c}, m_{c})) AS s_{c}" for c in _GAPS
    ) + " FROM fs, medians WHERE split = 'train'",
))
def _(spark, folder):
    split = _split(spark, folder)
    train = split.where(F.col("split") == "train")
    medians = {r["feature"]: r["median"] for r in M.exact_medians(train, _GAPS).collect()}
    stats = M.scale_statistics(train, medians, _GAPS).first()
    return split.select("order_id", *[
        F.round((M.imputed(c, medians) - stats[f"{c}__mean"]) / stats[f"{c}__std"], 6).alias(c) for c in _GAPS
    ])


@register("one_hot_wide", compose(
    "SELECT order_id, " + ", ".join(
        f"coalesce((SELECT slot FROM l_{c} l WHERE l.v = fs.{c}), -1)::INTEGER AS slot_{c}" for c in C.CATEGORICAL_FEATURES
    ) + " FROM fs", **_SPLIT_FEATURES, **{
        f"l_{c}": f"SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM (SELECT DISTINCT {c} AS v FROM fs WHERE split = 'train')"
        for c in C.CATEGORICAL_FEATURES
    },
))
def _(spark, folder):
    """Position of the one active slot per category column; -1 when unseen in training."""
    split = _split(spark, folder)
    train = split.where(F.col("split") == "train")
    encoders = [s for s in M.preparation(train, scaled=False)[:3]]
    encoded = Pipeline(stages=encoders).fit(train.select(*C.MODEL_FEATURES)).transform(split)
    return encoded.select("order_id", *[
        (F.array_position(vector_to_array(f"hot_{c}"), 1.0) - 1).cast("int").alias(f"slot_{c}")
        for c in C.CATEGORICAL_FEATURES
    ])


def _fit_and_score(candidate: M.Candidate):
    def run(spark, folder):
        _, parts = prepared_split(feature_table(spark, folder), stored=True)
        model = _fit_once(spark, folder)(candidate, parts["train"])
        rest = parts["validation"].unionByName(parts["test"])
        return M.score(model, rest).select(C.ORDER_KEY, C.TARGET, "split", "risk_score")

    return run


register("fit_score_gbt")(_fit_and_score(M.BASELINE))
register("fit_score_gbt_shallow")(_fit_and_score(M.SHALLOW))
register("fit_score_logit")(_fit_and_score(M.LOGISTIC))


@lru_cache(maxsize=4)
def _baseline(spark, application, folder):
    return train_baseline(feature_table(spark, folder), M.BASELINE, _fit_once(spark, folder), stored=True)


def _outcome(spark, folder):
    return _baseline(spark, spark.sparkContext.applicationId, folder)


@register("train_report")
def _(spark, folder):
    return _outcome(spark, folder).report


@register("candidate_comparison")
def _(spark, folder):
    return compare_candidates(feature_table(spark, folder), fit=_fit_once(spark, folder), stored=True).comparison


# Every state and year of the retail tables is a valid request; every 89th request lost its state on the way.
SCORE_BOUNDS = {"years": (1990, 2030), "state_pattern": "^NATION_[0-9]+$"}


@register("batch_score")
def _(spark, folder):
    """Decisions of the valid requests and, with their reasons, the quarantined ones."""
    outcome = _outcome(spark, folder)
    requests = feature_table(spark, folder).drop(C.PURCHASE_TIME, C.TARGET).withColumn(
        "customer_state", F.when(F.col(C.ORDER_KEY) % 89 != 0, F.col("customer_state"))
    )
    decided, held = score_batch(outcome.model, requests, outcome.threshold, outcome.winner, **SCORE_BOUNDS)
    return decided.unionByName(held.select(C.ORDER_KEY, "reasons"), allowMissingColumns=True)
