"""Writers: feature files, reports, models. The snapshot table is in ``snapshots``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from parceltide import contracts as C
from parceltide.operators.validate import ContractViolation

FEATURE_ORDER = (C.PURCHASE_TIME, C.ORDER_KEY)


def write_features(features: DataFrame, path: str) -> None:
    """Snappy Parquet; fails when the path already holds data."""
    features.write.mode("errorifexists").option("compression", "snappy").parquet(path)


def replace_features(features: DataFrame, path: str) -> None:
    """Chronologically sorted Parquet, one range of the order per file; replaces earlier output, creates parents.

    The order is proved from the written files.
    """
    features.orderBy(*FEATURE_ORDER).write.mode("overwrite").parquet(path)
    found = order_check(features.sparkSession, path).first()
    if found["inversions_within"] or found["inversions_between"]:
        raise ContractViolation(f"{path} is not in order: {found.asDict()}")


def file_bounds(spark: SparkSession, path: str, order: Sequence[str] = FEATURE_ORDER) -> DataFrame:
    """(file, n, first, last, inversions) of every Parquet file: its rows, first and last key, rows before a smaller one.

    The window sees the key columns of one file at a time.
    """
    rows = spark.read.parquet(path).select(
        F.struct(*order).alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("before", before).groupBy("file").agg(
        F.count("*").alias("n"), F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last"),
        F.count_if(F.col("before") > F.col("key")).alias("inversions"),
    )


def order_check(spark: SparkSession, path: str, order: Sequence[str] = FEATURE_ORDER) -> DataFrame:
    """One row that proves or refutes the order of a written table: row count, outer keys, inversions inside files and
    between neighbours. File names ascend with the ranges; the neighbours are one row per file."""
    bounds = file_bounds(spark, path, order)
    beside = bounds.withColumn("left", F.lag("last").over(Window.orderBy("file")))
    key = lambda c, name: F.col(c)[name].alias(f"{c}_{name}")
    return beside.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("inversions"), F.lit(0)).alias("inversions_within"),
        F.count_if(F.col("left") > F.col("first")).alias("inversions_between"),
        F.min_by("first", "file").alias("first"), F.max_by("last", "file").alias("last"),
    ).select("n_rows", "inversions_within", "inversions_between", *[key(c, n) for c in ("first", "last") for n in order])


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def save_artifacts(model: PipelineModel, report: DataFrame, folder: str) -> None:
    model.write().overwrite().save(f"{folder}/model")
    write_report(report, f"{folder}/report")


def load_artifacts(spark: SparkSession, folder: str) -> tuple[PipelineModel, str, float]:
    """Model, winner name and threshold, after checking the report's contract."""
    row = spark.read.json(f"{folder}/report").first().asDict(recursive=True)
    if tuple(row.get("model_feature_columns") or ()) != C.MODEL_FEATURES:
        raise ValueError("report feature columns do not match the contract")
    winner, threshold = row.get("winner"), row.get("selected_threshold")
    if not isinstance(winner, str) or isinstance(threshold, bool) or not isinstance(threshold, (int, float)):
        raise ValueError("report must hold a winner and a threshold")
    if not math.isfinite(threshold) or not 0 <= threshold <= 1:
        raise ValueError("stored threshold must be finite and in [0, 1]")
    return PipelineModel.load(f"{folder}/model"), winner, float(threshold)
