"""The snapshot table: an insert-only history published in versions.

A merge writes its rows to a folder of its own and then registers that folder as the
next partition of the table. Readers see registered partitions only, and the catalog
registers a number once: a lost driver leaves an unread folder behind, and of two merges
that run at once the second finds its number taken, looks at what the first one added,
and publishes the rest under the next number.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide import contracts as C
from parceltide.operators.reconcile import rows_to_insert
from parceltide.operators.validate import count_violations, enforce, key_violations

VERSION = "load_version"


def create_snapshot(spark: SparkSession, table: str, location: str, order_key_type: str = "string") -> None:
    """The 33 columns, and the version that brought a row."""
    kinds = {**C.FEATURE_TYPES, C.ORDER_KEY: order_key_type}
    columns = ", ".join(
        f"{c} {kinds[c]}{' NOT NULL' if c in C.NOT_NULL_FEATURES else ''}" for c in C.FEATURE_ROW
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {VERSION} bigint) USING parquet "
        f"PARTITIONED BY ({VERSION}) LOCATION '{location}'"
    )


def check_source(source: DataFrame) -> None:
    """Parquet tables enforce neither NOT NULL nor keys, so both are counted before anything is written."""
    rules = [("not_null", c, F.col(c).isNull()) for c in C.NOT_NULL_FEATURES]
    enforce(count_violations("snapshot", source, rules).unionByName(key_violations(source, [C.ORDER_KEY], "snapshot")))


def published_versions(spark: SparkSession, table: str) -> set[int]:
    return {int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # one row per merge


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def publish(spark: SparkSession, table: str, version: int, folder: str) -> bool:
    """Register the folder as this version; False if the number is taken."""
    try:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({VERSION} = {version}) LOCATION '{folder}'")
    except AnalysisException as error:
        if "ALREADY_EXIST" in (error.getCondition() or ""):
            return False
        raise
    return True


def _written(rows: DataFrame, table: str) -> tuple[str, DataFrame]:
    """The rows in a folder next to the published ones; no reader looks there."""
    spark = rows.sparkSession
    folder = f"{_location(spark, table)}/_rows-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(folder)
    return folder, spark.read.schema(rows.schema).parquet(folder)


def merge_snapshot(source: DataFrame, table: str, attempts: int = 20) -> int | None:
    """Publish the orders the snapshot does not hold; existing rows never change. Returns the version, None without rows.

    A rerun publishes nothing. Only the key column of the snapshot is read.
    """
    check_source(source)
    spark = source.sparkSession
    seen = published_versions(spark, table)
    target = spark.table(table)
    columns = [c for c in target.columns if c != VERSION]
    folder, rows = _written(rows_to_insert(source, target, C.ORDER_KEY).select(*columns), table)
    for _ in range(attempts):
        if rows.limit(1).count() == 0:
            return None
        version = max(seen, default=0) + 1
        if publish(spark, table, version, folder):
            return version
        now = published_versions(spark, table)
        added = spark.table(table).where(F.col(VERSION).isin(sorted(now - seen)))
        if rows.join(added.select(C.ORDER_KEY), C.ORDER_KEY, "left_semi").limit(1).count():
            folder, rows = _written(rows_to_insert(rows, added, C.ORDER_KEY), table)
        seen = now
    raise RuntimeError(f"{table}: other merges took {attempts} versions in a row")
