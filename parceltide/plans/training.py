"""Experiments: baseline, candidate comparison, and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from parceltide import contracts as C
from parceltide.operators import evaluate as E, model as M, scoring
from parceltide.operators.validate import check_split, enforce
from parceltide.session import stage


@dataclass(frozen=True)
class Outcome:
    """A fitted experiment: model, winner, threshold and its one-row report."""

    model: PipelineModel
    winner: str
    threshold: float
    report: DataFrame
    comparison: DataFrame | None = None


Fit = Callable[[M.Candidate, DataFrame], PipelineModel]


def prepared_split(features: DataFrame, stored: bool = False) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Stored features with their split: the fits below read files, not the feature plan. ``stored`` ones are not stored again."""
    split = E.chronological_split(features if stored else stage(features, "features"))
    check_split(E.split_summary(split))
    return split, {name: split.where(F.col("split") == name) for name in E.SPLITS}


def scored_part(model: PipelineModel, part: DataFrame) -> DataFrame:
    """Checked, stored scores of one split: (key, target, score)."""
    scored = stage(M.score(model, part).select(C.ORDER_KEY, C.TARGET, "risk_score"), "scores")
    enforce(E.score_violations(scored))
    return scored


def _one_row(frame: DataFrame, name: str):
    return frame.select(F.struct(*frame.columns)).scalar().alias(name)


def _metrics(scored: DataFrame, threshold: float, name: str):
    both = E.threshold_metrics(scored, threshold).withColumn(
        "d", E.discrimination(E.score_curve(scored)).select(F.struct("roc_auc", "average_precision")).scalar()
    )
    return _one_row(both.select("d.*", *[c for c in both.columns if c != "d"]), name)


def _report(split: DataFrame, winner: str, threshold: float, *metrics) -> DataFrame:
    summary = E.split_summary(split)
    columns = summary.columns
    return summary.agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("splits")  # three rows
    ).select(
        F.lit(winner).alias("winner"), F.lit(threshold).alias("selected_threshold"),
        F.array(*map(F.lit, C.MODEL_FEATURES)).alias("model_feature_columns"),
        F.lit(C.SEED).alias("random_seed"), "splits", *metrics,
    )


def train_baseline(
    features: DataFrame, candidate: M.Candidate = M.BASELINE, fit: Fit = M.fit_candidate, stored: bool = False
) -> Outcome:
    """One model: threshold from validation, metrics on test, beside the prior baseline."""
    split, parts = prepared_split(features, stored)
    model = fit(candidate, parts["train"])
    validation, test = (scored_part(model, parts[p]) for p in ("validation", "test"))
    threshold = E.select_threshold(E.score_curve(validation)).first()["threshold"]
    prior = E.baseline_scores(split).select(C.ORDER_KEY, C.TARGET, "risk_score")
    report = _report(
        split, candidate.name, threshold,
        _metrics(test, threshold, "test"), _metrics(prior, 0.5, "prior_test"),
    )
    return Outcome(model, candidate.name, threshold, report)


def compare_candidates(
    features: DataFrame, candidates: Sequence[M.Candidate] = M.CANDIDATES, fit: Fit = M.fit_candidate, stored: bool = False
) -> Outcome:
    """Fit candidates one after another, select on validation, test only the winner."""
    split, parts = prepared_split(features, stored)
    fitted, validation, rows = {}, {}, []
    for candidate in sorted(candidates, key=lambda c: c.name):
        model = fitted[candidate.name] = fit(candidate, parts["train"])
        validation[candidate.name] = scored_part(model, parts["validation"])
        on_train = E.discrimination(E.score_curve(scored_part(model, parts["train"]))).first()
        on_validation = E.discrimination(E.score_curve(validation[candidate.name])).first()
        rows.append((
            candidate.name, on_train["roc_auc"], on_train["average_precision"],
            on_validation["roc_auc"], on_validation["average_precision"],
        ))
    comparison = split.sparkSession.createDataFrame(
        rows, "candidate string, train_roc_auc double, train_average_precision double, "
        "roc_auc double, average_precision double",
    )
    winner = E.select_candidate(comparison).first()["candidate"]
    threshold = E.select_threshold(E.score_curve(validation[winner])).first()["threshold"]
    # The same seed and data would refit the same model, so the fitted one is kept.
    test = scored_part(fitted[winner], parts["test"])
    ranking = E.topk_metrics(test)
    report = _report(
        split, winner, threshold,
        _metrics(validation[winner], threshold, "validation"), _metrics(test, threshold, "test"),
    ).withColumn(
        "test_ranking",
        ranking.agg(F.sort_array(F.collect_list(F.struct(*ranking.columns)))).scalar(),  # three rows
    )
    return Outcome(fitted[winner], winner, threshold, report, comparison)


def score_batch(outcome_or_model, requests: DataFrame, threshold: float, name: str, **bounds) -> tuple[DataFrame, DataFrame]:
    """(decisions of valid requests, quarantined requests with their reasons)."""
    return _score_judged(outcome_or_model, scoring.judge_requests(requests, **bounds), threshold, name)


def score_bodies(outcome_or_model, bodies: DataFrame, threshold: float, name: str, body: str = "body", **bounds) -> tuple[DataFrame, DataFrame]:
    """The same for JSON requests: one with missing, extra or mistyped keys is quarantined alone."""
    return _score_judged(outcome_or_model, scoring.judge_bodies(bodies, body, **bounds), threshold, name)


def _score_judged(outcome_or_model, judged: DataFrame, threshold: float, name: str) -> tuple[DataFrame, DataFrame]:
    valid = judged.where("valid").drop("valid", "reasons")
    scored = M.score(outcome_or_model, valid)
    return scoring.decisions(scored, threshold, name), judged.where(~F.col("valid"))
