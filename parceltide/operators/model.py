"""Feature preprocessing and the model candidates, on ``pyspark.ml``."""

from __future__ import annotations

from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from parceltide import contracts as C
from parceltide.operators.boosting import Boosting, SecondOrderBoosting
from parceltide.operators.selection import column_quantile

FEATURES, LABEL, WEIGHT = "features", "label", "weight"


@dataclass(frozen=True)
class Candidate:
    """One model family with its fixed parameters."""

    name: str
    kind: str  # "boosted" or "regularised", both second-order trees, or "logistic"
    scaled: bool = False
    iterations: int = 300
    depth: int = 4
    step: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 1  # the least hessian sum of a child
    penalty: float = 0.0
    least_gain: float = 0.0
    strength: float = 1.0


# Parameters of the three candidates.
BASELINE = Candidate("xgboost_baseline", "boosted", penalty=1.0)
SHALLOW = Candidate(
    "xgboost_shallow_regularized", "regularised",
    iterations=400, depth=2, step=0.03, min_rows=5, penalty=5.0, least_gain=0.1,
)
LOGISTIC = Candidate("logistic_regression_balanced", "logistic", scaled=True, iterations=1000)
CANDIDATES = (BASELINE, SHALLOW, LOGISTIC)


def numeric_frame(frame: DataFrame, columns=C.NUMERIC_FEATURES) -> DataFrame:
    return frame.select(*[F.col(c).cast("double").alias(c) for c in columns])


def exact_medians(train: DataFrame, columns=C.NUMERIC_FEATURES) -> DataFrame:
    """(feature, median) over the non-missing training values; a few passes for all columns together."""
    medians = column_quantile(numeric_frame(train, columns), columns, 0.5)
    return train.sparkSession.createDataFrame(list(medians.items()), "feature string, median double")


_MEDIANS: WeakKeyDictionary[DataFrame, dict[str, float]] = WeakKeyDictionary()


def _medians_of(train: DataFrame) -> dict[str, float]:
    """Candidates that are fitted on the same frame share its medians."""
    if train not in _MEDIANS:
        _MEDIANS[train] = {r["feature"]: r["median"] for r in exact_medians(train).collect()}
    return _MEDIANS[train]


def scale_statistics(train: DataFrame, medians: dict[str, float], columns=C.NUMERIC_FEATURES) -> DataFrame:
    """One row: mean and population deviation of each imputed column; a constant scales by 1."""
    filled = numeric_frame(train, columns).select(*[imputed(c, medians).alias(c) for c in columns])
    spread = lambda c: F.stddev_pop(c)
    return filled.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.when(spread(c) > 0, spread(c)).otherwise(F.lit(1.0)).alias(f"{c}__std") for c in columns],
    )


def imputed(column: str, medians: dict[str, float]) -> Column:
    """The value as a double, or the training median; 0 when training had no value."""
    return F.coalesce(F.col(column).cast("double"), F.lit(float(medians.get(column, 0.0))))


def impute(frame: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Numeric gaps get the training median, or 0 without one, categorical gaps a constant label."""
    filled = {c: imputed(c, medians) for c in C.NUMERIC_FEATURES if c in frame.columns}
    filled |= {
        c: F.coalesce(F.col(c), F.lit(C.MISSING_LABEL)) for c in C.CATEGORICAL_FEATURES if c in frame.columns
    }
    return frame.select(*[filled.get(c, F.col(c)).alias(c) for c in frame.columns])


def preparation(train: DataFrame, scaled: bool) -> list:
    """Fitted imputation (and scaling) as a saveable SQL stage, then the encoders.

    Unseen labels go to the indexer's extra slot, which the encoder drops, so
    they become all zeros.
    """
    medians = _medians_of(train)
    stats = scale_statistics(train, medians).first().asDict() if scaled else {}
    columns = []
    for c in C.NUMERIC_FEATURES:
        value = f"coalesce(cast({c} AS double), {float(medians.get(c, 0.0))!r}D)"
        if scaled:
            value = f"({value} - {stats[f'{c}__mean']!r}D) / {stats[f'{c}__std']!r}D"
        columns.append(f"{value} AS num_{c}")
    columns += [f"coalesce({c}, '{C.MISSING_LABEL}') AS cat_{c}" for c in C.CATEGORICAL_FEATURES]
    cats = C.CATEGORICAL_FEATURES
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__"),
        StringIndexer(
            inputCols=[f"cat_{c}" for c in cats], outputCols=[f"idx_{c}" for c in cats],
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=[f"idx_{c}" for c in cats], outputCols=[f"hot_{c}" for c in cats], dropLast=True),
        VectorAssembler(
            inputCols=[f"num_{c}" for c in C.NUMERIC_FEATURES] + [f"hot_{c}" for c in cats], outputCol=FEATURES
        ),
    ]


def class_balance(train: DataFrame) -> tuple[int, int]:
    row = train.agg(F.count("*").alias("n"), F.sum(F.col(C.TARGET).cast("bigint")).alias("late")).first()
    late = row["late"] or 0
    if late == 0 or late == row["n"]:
        raise ValueError("training split must contain both target classes")
    return row["n"] - late, late


def classifier(candidate: Candidate, on_time: int, late: int):
    """(estimator, weight of a late row, weight of an on-time row)."""
    shared = dict(featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT)
    if candidate.kind != "logistic":
        how = Boosting(
            rounds=candidate.iterations, depth=candidate.depth, rate=candidate.step, row_share=candidate.row_share,
            column_share=candidate.column_share, least_weight=float(candidate.min_rows), penalty=candidate.penalty,
            least_gain=candidate.least_gain, seed=C.SEED,
        )
        return SecondOrderBoosting(how, FEATURES), on_time / late, 1.0
    rows = on_time + late
    # Balanced weights sum to the row count, so strength C is the penalty 1 / (C * rows).
    estimator = LogisticRegression(
        maxIter=candidate.iterations, elasticNetParam=0.0,
        regParam=1.0 / (candidate.strength * rows), standardization=False, **shared,
    )
    return estimator, rows / (2.0 * late), rows / (2.0 * on_time)


def fit_candidate(candidate: Candidate, train: DataFrame) -> PipelineModel:
    """Fit preprocessing and classifier on the training rows only."""
    estimator, late_weight, on_time_weight = classifier(candidate, *class_balance(train))
    labelled = train.select(
        *C.MODEL_FEATURES, F.col(C.TARGET).cast("double").alias(LABEL),
        F.when(F.col(C.TARGET) == 1, late_weight).otherwise(on_time_weight).alias(WEIGHT),
    )
    return Pipeline(stages=[*preparation(train, candidate.scaled), estimator]).fit(labelled)


def score(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """Add ``risk_score``, the late-class probability; every input column is kept."""
    scored = model.transform(frame).withColumn("risk_score", vector_to_array("probability")[1])
    return scored.select(*frame.columns, "risk_score")
