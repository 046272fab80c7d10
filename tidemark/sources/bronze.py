"""Bronze Parquet lake with ``dt=/hh=`` partitions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def bronze_path(root: str, source: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{source}/{dataset}"


def write_bronze(
    df: DataFrame,
    root: str,
    source: str,
    dataset: str,
    partition_ts: datetime | Column | None = None,
    overwrite_partition: bool = True,
) -> str:
    """Write a load to its hour partition and return the dataset path; an empty frame writes nothing.

    ``partition_ts`` is one instant for the load (default: now, UTC) or a column, which
    backfills many hours at once. With ``overwrite_partition`` exactly the partitions present
    in ``df`` are replaced, so a re-run leaves no duplicates; otherwise files are added.
    """
    if df.isEmpty():
        return ""
    if not isinstance(partition_ts, Column):
        moment = partition_ts or datetime.now(timezone.utc)
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc)
        dt, hh = F.lit(moment.strftime("%Y-%m-%d")), F.lit(moment.strftime("%H"))
    else:
        dt, hh = F.date_format(partition_ts, "yyyy-MM-dd"), F.date_format(partition_ts, "HH")
    path = bronze_path(root, source, dataset)
    (
        df.withColumns({"dt": dt, "hh": hh})
        # One file for each hour and advised size: a backfill of many hours is not scattered over all
        # tasks, and a hot hour is still written by many.
        .hint("rebalance", "dt", "hh")
        .write.mode("overwrite" if overwrite_partition else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("dt", "hh")
        .parquet(path)
    )
    return path


def read_bronze(spark: SparkSession, root: str, source: str, dataset: str) -> DataFrame:
    """The dataset with ``dt`` and ``hh`` as text; filters on them prune directories."""
    df = spark.read.parquet(bronze_path(root, source, dataset))
    return df.withColumns({"dt": F.col("dt").cast("string"), "hh": F.lpad(F.col("hh").cast("string"), 2, "0")})


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``: key, size, modification time. File contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.col("path").alias("key"),
        F.round(F.col("length") / 1024, 1).alias("size_kb"),
        F.col("modificationTime").alias("last_modified"),
    )


def newest_file(spark: SparkSession, path: str) -> DataFrame:
    """The most recently written file, as a one-row inventory."""
    return inventory(spark, path).orderBy(F.desc("last_modified"), F.desc("key")).limit(1)


def peek(spark: SparkSession, file: str, rows: int = 10) -> DataFrame:
    """First rows of one file."""
    return spark.read.parquet(file).limit(rows)
