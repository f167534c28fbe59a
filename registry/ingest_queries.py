"""The CSV path end to end: text files, header contract, ingest, validated build."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide import contracts as C
from parceltide.plans.ingest import ingest
from parceltide.plans.order_features import build_order_features
from parceltide.session import staging_root
from parceltide.operators.validate import union_all
from parceltide.sources.csv_files import header_differences, uri_join
from registry.common import register, retail_sources
from registry.views import compose


def write_csv_sources(spark: SparkSession, sources: dict[str, DataFrame]) -> str:
    """Store the sources as CSV under the contract's file names and headers."""
    root = f"{staging_root(spark)}/parceltide/csv-{uuid.uuid4().hex}"
    for name, frame in sources.items():
        filename = C.SOURCE_FILES[name]
        frame.select(*[
            (F.col(c).cast("string") if c in frame.columns else F.lit("")).alias(c)
            for c in C.SOURCE_HEADERS[name]
        ]).write.option("header", True).csv(uri_join(root, filename))
    return root


@register("scan_sources", compose("SELECT * REPLACE (order_id::VARCHAR AS order_id) FROM features"))
def _(spark, folder):
    """Retail tables written as CSV text, ingested, validated and built.

    The build rejects delivered orders without items, which the tables have, so
    such an order is written as canceled. Every row of every table is scanned.
    """
    src = retail_sources(spark, folder)
    owners = src["items"].select("order_id", F.lit(True).alias("owns")).distinct()
    orders = src["orders"].join(owners, "order_id", "left").withColumn(
        "order_status", F.when(F.col("owns"), F.col("order_status")).otherwise("canceled")
    )
    root = write_csv_sources(spark, {**src, "orders": orders.drop("owns")})
    return build_order_features(ingest(spark, root), one_order_per_customer=False)


# Two folders with a bad header: the columns of the sellers are swapped; the customers hold one more file, which lacks a column.
_BAD_HEADERS = (
    ("renamed", "sellers", 2, "seller_zip_code_prefix", "seller_zip"),
    ("mixed", "customers", len(C.SOURCE_HEADERS["customers"]), C.SOURCE_HEADERS["customers"][-1], None),
)


@register("header_contract", "SELECT * FROM (VALUES " + ", ".join(
    f"('{f}', '{s}', {p}, '{e}', {'NULL' if g is None else repr(g)}, 1)" for f, s, p, e, g in _BAD_HEADERS
) + ") t(folder, source, position, expected, found, files)")
def _(spark, folder):
    """The headers of every file of the CSV sources: one good folder, two with a bad file beside good ones."""
    src = retail_sources(spark, folder)
    roots = {"good": write_csv_sources(spark, src)}
    for name in ("renamed", "mixed"):
        roots[name] = write_csv_sources(spark, {n: src[n] for n in ("sellers", "customers")})
    text = lambda name, columns: src[name].select(*[
        (F.col(c).cast("string") if c in src[name].columns else F.lit("")).alias(c) for c in columns
    ]).coalesce(1).write.mode("append").option("header", True)
    text("customers", C.SOURCE_HEADERS["customers"][:-1]).csv(uri_join(roots["mixed"], C.SOURCE_FILES["customers"]))
    renamed = src["sellers"].select(*[
        (F.col(c).cast("string") if c in src["sellers"].columns else F.lit("")).alias("seller_zip" if c == "seller_zip_code_prefix" else c)
        for c in C.SOURCE_HEADERS["sellers"]
    ])
    renamed.coalesce(1).write.mode("append").option("header", True).csv(uri_join(roots["renamed"], C.SOURCE_FILES["sellers"]))
    found = [
        header_differences(spark, {n: uri_join(root, C.SOURCE_FILES[n]) for n in (C.SOURCE_FILES if name == "good" else ("sellers", "customers"))})
        .select(F.lit(name).alias("folder"), "*") for name, root in roots.items()
    ]
    return union_all(found).groupBy("folder", "source", "position", "expected", "found").agg(F.count("*").cast("int").alias("files"))
