"""From the consumer's batches to the warehouse: a commit log, compaction of closed days, touched hours.

The consumer leaves ``ticks/dt=…/batch_id=…`` folders and one commit per batch. A closed day is rewritten once
into the warehouse's ``ticks`` table, which keeps the batch id of its rows, so a repeated or interrupted run neither
loses nor doubles rows; late ticks of a closed day rewrite that day again. What was moved is logged by (day, batch) and
then removed. Open days are read where the consumer left them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas
from tidemark.functions import columns as C
from tidemark.session import settle
from tidemark.sources.warehouse import PARTITION, Warehouse
from tidemark.streaming import ticks as S

TICKS_DDL = "batch_id BIGINT, dt DATE"
LOG_DDL = "dt DATE, batch_id BIGINT"


def _with(schema: T.StructType, ddl: str) -> T.StructType:
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def _log(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def moved(spark: SparkSession, root: str) -> DataFrame:
    """(dt, batch_id) pairs whose ticks are in the warehouse."""
    return _log(spark, f"{root}/moved", LOG_DDL).distinct()


def committed_days(spark: SparkSession, root: str) -> DataFrame:
    """(dt, batch_id) pairs of committed batches that are not in the warehouse yet. One row per batch and day."""
    days = S.read_commits(spark, root).where("event_hour IS NOT NULL").select(F.to_date("event_hour").alias("dt"), "batch_id")
    return days.distinct().join(moved(spark, root), ["dt", "batch_id"], "left_anti")


def open_ticks(spark: SparkSession, root: str) -> DataFrame:
    """Committed ticks that still lie where the consumer left them, with ``dt`` and ``batch_id``."""
    incoming = _log(spark, f"{root}/ticks", _with(schemas.ticks(), TICKS_DDL))
    return incoming.join(committed_days(spark, root), ["dt", "batch_id"], "left_semi")


def all_ticks(warehouse: Warehouse, root: str, since: C.AsOf = None, until: C.AsOf = None) -> DataFrame:
    """Ticks of the warehouse and of open days; bounds prune the days of both."""
    arrived = open_ticks(warehouse.spark, root)
    if since is not None:
        arrived = arrived.where((F.col("dt") >= F.to_date(C.as_of_ts(since))) & (F.col("event_time") >= C.as_of_ts(since)))
    if until is not None:
        arrived = arrived.where((F.col("dt") <= F.to_date(C.as_of_ts(until))) & (F.col("event_time") < C.as_of_ts(until)))
    return warehouse.read("ticks", since, until).unionByName(C.conform(arrived, schemas.ticks()))


def compact(warehouse: Warehouse, root: str, as_of: C.AsOf = None) -> int:
    """Move the days before ``as_of`` into the warehouse; returns the number of (day, batch) folders moved."""
    spark = warehouse.spark
    closed = F.col("dt") < F.to_date(C.as_of_ts(as_of))
    # One row per micro-batch and day since the last run: bounded by the clock, not by the ticks.
    todo = settle(committed_days(spark, root).where(closed), "compaction")
    days = [r[0] for r in todo.select("dt").distinct().collect()]
    if not days:
        return 0
    full = _with(schemas.ticks(), TICKS_DDL)
    stored = _log(spark, warehouse.path("ticks"), full).where(F.col("dt").isin(days))
    kept = stored.join(todo, ["dt", "batch_id"], "left_anti")  # of an interrupted run
    new = _log(spark, f"{root}/ticks", full).where(F.col("dt").isin(days)).join(todo, ["dt", "batch_id"], "left_semi")
    warehouse.write_days("ticks", kept.unionByName(new, allowMissingColumns=True))
    todo.select("dt", "batch_id").coalesce(1).write.mode("append").parquet(f"{root}/moved")
    _remove_moved(spark, root, days)
    return todo.count()


def _remove_moved(spark: SparkSession, root: str, days: list) -> None:
    """Remove the consumer's folders that the log names; one that is left over is ignored by every reader."""
    done = {(str(r.dt), r.batch_id) for r in moved(spark, root).where(F.col("dt").isin(days)).collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for day in days:
        for entry in files.globStatus(path(f"{root}/ticks/{PARTITION}={day}/batch_id=*")) or []:
            folder = entry.getPath()
            if (str(day), int(folder.getName().split("=")[1])) in done:
                files.delete(folder, True)


def touched_hours(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, event_hour) of committed batches whose hours were not refreshed yet, late ticks included."""
    commits = S.read_commits(spark, root).where("event_hour IS NOT NULL").select("batch_id", "event_hour").distinct()
    return commits.join(_log(spark, f"{root}/refreshed", "batch_id BIGINT").distinct(), "batch_id", "left_anti")


def mark_refreshed(touched: DataFrame, root: str) -> None:
    touched.select("batch_id").distinct().coalesce(1).write.mode("append").parquet(f"{root}/refreshed")
