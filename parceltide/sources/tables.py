"""Stored feature tables: typed scans, listings, schema inventory, manifests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide import contracts as C
from parceltide.sources import digests


def read_external(spark: SparkSession, path: str, order_key_type: str = "string") -> DataFrame:
    """Parquet part files projected onto the fixed, explicitly cast 33 columns."""
    files = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    kinds = {**C.FEATURE_TYPES, C.ORDER_KEY: order_key_type}
    return files.select(*[F.col(c).cast(kinds[c]).alias(c) for c in C.FEATURE_ROW])


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """Contract-checked feature table for training. Missing purchase times are allowed; the split puts them last."""
    from parceltide.operators.validate import enforce, feature_violations

    frame = spark.read.parquet(path)
    required = (*C.METADATA, *C.MODEL_FEATURES, C.TARGET)
    missing = sorted(set(required) - set(frame.columns))
    if missing:
        raise ValueError(f"feature table lacks required columns: {missing}")
    frame = frame.select(*required)
    enforce(feature_violations(frame, target_values=False))
    return frame


def _below(root: str) -> Column:
    """Path of a file relative to ``root``, whatever scheme the listing puts before it."""
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    return F.expr("substring_index(path, root, -1)".replace("root", repr(f"{bare}/")))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Every file below ``path`` with its relative name and size; contents are not read, files without bytes not listed."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
        .select(_below(path).alias("filename"), "path", "length", "modificationTime")
    )


def schema_inventory(frame: DataFrame) -> DataFrame:
    """(ordinal_position, column_name, data_type, nullable), in column order.

    ``nullable`` is observed: the column holds at least one NULL. Parquet schemas
    written by Spark declare every column nullable, so the declaration says nothing.
    """
    gaps = frame.agg(*[F.count_if(F.col(f.name).isNull()).alias(f"g{i}") for i, f in enumerate(frame.schema)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("ordinal_position"), F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"), (F.col(f"g{i}") > 0).alias("nullable"),
        )
        for i, f in enumerate(frame.schema)
    ]
    return gaps.select(F.inline(F.array(*rows)))


def expected_inventory(spark: SparkSession) -> DataFrame:
    """The contract in the same shape."""
    rows = [
        (i, c, C.FEATURE_TYPES[c], c not in C.NOT_NULL_FEATURES) for i, c in enumerate(C.FEATURE_ROW, start=1)
    ]
    layout = "ordinal_position int, column_name string, data_type string, nullable boolean"
    return spark.createDataFrame(rows, layout)


def stream_scheme(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open the files below ``path`` by themselves."""
    if "://" not in path:
        path = "file://" if path.startswith("file:") else spark.conf.get("spark.hadoop.fs.defaultFS", "file://")
    return path.partition("://")[0] in digests.STREAMED


def build_manifest(spark: SparkSession, path: str, glob: str = "*", block_bytes: int = digests.BLOCK_BYTES) -> DataFrame:
    """(filename, size_bytes, sha256_hex, sha256_base64) for each file below ``path``.

    ``filename`` is the path below the root, so equal names in two folders stay apart. Files are read as streams of
    ``block_bytes``, whatever their size; only under a scheme that tasks cannot open themselves they are loaded whole.
    """
    if stream_scheme(spark, path):
        found = digests.file_digests(list_files(spark, path, glob), block_bytes)
    else:
        found = digests.whole_file_digests(
            spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
            .select(_below(path).alias("filename"), "content")
        )
    return found.withColumn("sha256_base64", F.base64(F.unhex("sha256_hex")))


_ENTRY = ("size_bytes", "sha256_hex", "sha256_base64")


def verify_manifest(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per filename with its status: ok, missing, unexpected, size or checksum.

    Both sides are tagged and grouped by name, so that names listed very often combine before the shuffle. Entries of
    one name must all agree, also within one side. Entries without a name count as one name.
    """
    tagged = expected.select("filename", *_ENTRY, F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        actual.select("filename", *_ENTRY, F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    spread = lambda c: (F.min(c) != F.max(c)) | (F.count(c) != F.count("*"))
    return tagged.groupBy("filename").agg(
        F.max("e").alias("e"), F.max("a").alias("a"), spread("size_bytes").alias("size"),
        (spread("sha256_hex") | spread("sha256_base64")).alias("checksum"),
    ).select(
        "filename",
        F.when(F.col("a") == 0, "missing").when(F.col("e") == 0, "unexpected").when(F.coalesce("size", F.lit(True)), "size")
        .when(F.coalesce("checksum", F.lit(True)), "checksum").otherwise("ok").alias("status"),
    )


_WORST_FIRST = ("missing", "unexpected", "size", "checksum", "ok")


def table_status(verified: DataFrame) -> DataFrame:
    """(filename, status) per table of ``verify_manifest``: a Parquet folder is one entry, with the worst status of its files."""
    table = F.regexp_extract("filename", r"^(.*?\.parquet)(/|$)", 1)
    name = F.when(table != "", table).otherwise(F.col("filename"))
    ranks = F.array(*map(F.lit, _WORST_FIRST))
    worst = F.min(F.array_position(ranks, F.col("status"))).cast("int")
    return verified.groupBy(name.alias("filename")).agg(worst.alias("rank")).select(
        "filename", F.element_at(ranks, F.col("rank")).alias("status")
    )
