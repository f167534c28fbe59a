"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` writes each result as Parquet and
hands the files to the next stage, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide.llm import decontaminate, line_dedup, mixing, simhash_similar, toxicity
from parceltide.session import prepare, stage

# No document is left out: the budget lets the most over-represented source be read once, the others twice at most.
MIX = mixing.Mix(entropy=0.97, most_repeats=2.0, keep_all=True)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    prepare(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least three documents stay in one; ``n_chars`` follows the text."""
    prepare(spark)
    kept = line_dedup.with_bitmaps(docs)
    changed = kept.withColumn("text", F.when(F.col("_keep").isNull(), F.col("text")).otherwise(line_dedup.kept_text("text", "_keep")))
    return changed.withColumn(
        "n_chars", F.when(F.col("_keep").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
    ).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group stays.

    Links are SimHash fingerprints within three bits, as in op8, and five-word shingle sets of similarity 0.8,
    which lie beyond what three bits catch.
    """
    prepare(spark)
    return simhash_similar.keep_one(docs, fingerprints=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    prepare(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per reading of a document, with its round, block and source weight."""
    prepare(spark)
    return mixing.mixed_rows(docs, MIX)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Model fits, fingerprints and permutations are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
