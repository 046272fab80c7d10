"""Session defaults and the shared work area."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Calendar maths (day buckets, YYYYMMDD keys) is defined in UTC everywhere.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
# Somewhat less than the 4 MB that operators take at a time (textops.SLICE_BYTES), so that a batch is one slice.
BATCH_BYTES = 3840 << 10

BUILD_CONF = {
    **RUNTIME_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the project defaults; ``conf`` entries win over them.

    No shuffle-partition count is fixed here: on a cluster set
    ``spark.sql.shuffle.partitions`` high and let AQE merge small partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def bound_batches(spark: SparkSession) -> SparkSession:
    """Limit the Arrow batches that Python workers get to about ``BATCH_BYTES``, however many rows those are; a session
    that set less keeps it.

    Spark's own limits, 10,000 rows or 64 MB, make one batch of a whole split of documents, and a batch is held several
    times at once: as vectors that doubled while they grew, as the stream to the worker, and in the worker.
    """
    before = spark.conf.get(BATCH_LIMIT, None)
    if before is None or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, f"{BATCH_BYTES}b")
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per Spark application.

    Functions that run in Python workers refer to it by name, and workers see only their own import path.
    """
    _ship(spark.sparkContext.applicationId, spark)
    return spark


@cache
def _ship(application: str, spark: SparkSession) -> None:
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-code-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where that is unset and the session runs in one process (tests, a laptop) a local folder is
    made, once per process; on a cluster each executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not _one_process(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


def _one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors: later stages re-read the
    files instead of recomputing the whole upstream plan. ``path`` is a :func:`scratch_path`
    that the caller means to :func:`discard`.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder once everything built on it is stored; other paths are refused."""
    if not path.startswith(f"{shared_dir(spark)}/tidemark/"):
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
