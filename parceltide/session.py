"""Session settings and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

# Lets adaptive execution split a hot join key even where the split costs an
# extra exchange; without it a key that owns a third of the rows is one task
# whenever an aggregate on the same key follows the join.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Bytes sent to a Python worker at once, which holds them twice while it reads them.
BATCH_BYTES = 4 << 20


def apply_skew_settings(spark: SparkSession) -> SparkSession:
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Skew settings, and Python workers that find this package where it lies on every machine.

    Elsewhere ship it with ``--py-files``. Batches of whole texts are kept small on their way to Python.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    return apply_skew_settings(spark)


def size_shuffles(spark: SparkSession, path: str, bytes_each: int = 256 << 20) -> int:
    """Raise the shuffle partition count to fit the files below ``path``, for the jobs of this session.

    The default of 200 would mean hundreds of gigabytes per partition on a large
    input. File sizes come from a listing; adaptive execution merges what turns
    out small.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    total = files.agg(F.sum("length")).first()[0] or 0
    partitions = max(shuffle_width(spark), total // bytes_each)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


# Shuffled rows of a feature build take a few hundred MB in a task's sorts and aggregates per 16 MB on the wire.
TASK_BYTES = 16 << 20
# Input bytes for which a shuffle gets one more partition: decimals and order columns make items four times larger there.
PARTITION_INPUT = 4 << 20


@lru_cache(maxsize=64)
def _bytes_below(spark: SparkSession, application: str, paths: tuple[str, ...]) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.sum("length")).first()[0] or 0


def bound_tasks(spark: SparkSession, paths: Sequence[str]) -> int:
    """Shuffle partitions for jobs over these files, so that a task's memory does not grow with them.

    Never lowers the number that is set; what turns out small is merged up to ``TASK_BYTES``, unless the session says otherwise.
    """
    partitions = max(shuffle_width(spark), -(-_bytes_below(spark, spark.sparkContext.applicationId, tuple(paths)) // PARTITION_INPUT))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    if spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) in (None, "64MB", f"{64 << 20}b"):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    return partitions


def local_session(cores: int | str = 8, app: str = "parceltide") -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        # Small test shuffles still spread over all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256KB")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_skew_settings(spark)


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="parceltide-")


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever made up for a local master, where the
    driver and the tasks see the same disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master.startswith("local")
    if folder:
        if not local and folder.startswith("file:"):
            raise RuntimeError(f"spark.checkpoint.dir {folder} is a folder of one machine")
        return folder.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder(context.applicationId)


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` once as Parquet in the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, fixes values such as
    a partition id, keeps column pruning, and gives the planner a true size.
    """
    spark = frame.sparkSession
    path = f"{staging_root(spark)}/parceltide/{label}-{uuid.uuid4().hex}"
    frame.write.mode("errorifexists").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def batches(spark: SparkSession, rows: int, size: int = 2**31 - 1):
    """Batches for Python hold this many rows, or bytes."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
