"""Tables of the warehouse as Parquet folders: registry, reads, full refresh, keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas
from tidemark.functions import columns as C
from tidemark.session import settle

PARTITION = "dt"
# Derived tables that are stored by day, with the instant that gives the day.
DAILY_MARTS = {"fact_prices_hourly": "event_hour", "fact_market_snapshot": "snapshot_hour"}


@dataclass(frozen=True)
class TableSpec:
    """A maintained table.

    ``partition_by`` names the instant whose date partitions the table. It must not change
    for a given key: that is what lets an upsert touch only the partitions of its batch.
    ``update`` lists the columns an existing row takes from the batch; empty means first
    write wins, and no ``key`` means plain append.
    """

    name: str
    schema: T.StructType
    partition_by: str
    key: tuple[str, ...] = ()
    update: tuple[str, ...] = ()


def specs() -> dict[str, TableSpec]:
    sentiment, anomalies = schemas.sentiment(), schemas.anomalies()

    def all_but(schema: T.StructType, *left_alone: str) -> tuple[str, ...]:
        return tuple(n for n in schema.fieldNames() if n not in left_alone)

    listed = [
        TableSpec("ticks", schemas.ticks(), "event_time"),
        TableSpec("markets", schemas.markets(), "ingested_at"),
        TableSpec(
            "index", schemas.index(), "index_date", ("index_date",),
            ("value", "category", "time_until_update", "ingested_at"),
        ),
        TableSpec(
            "posts", schemas.posts(), "created_utc", ("id",),
            ("score", "upvote_ratio", "num_comments", "ingested_at"),
        ),
        # scored_at / detected_at keep the instant of the first write.
        TableSpec(
            "sentiment", sentiment, "created_utc", ("post_id",), all_but(sentiment, "post_id", "scored_at")
        ),
        TableSpec(
            "anomalies", anomalies, "event_hour", ("symbol", "event_hour"),
            all_but(anomalies, "symbol", "event_hour", "detected_at"),
        ),
        TableSpec("ledger", schemas.ledger(), "event_hour", ("alert_key",)),
    ]
    return {s.name: s for s in listed}


def merge_rows(
    current: DataFrame,
    batch: DataFrame,
    columns: Sequence[str],
    key: Sequence[str] = (),
    update: Sequence[str] = (),
) -> DataFrame:
    """State of a table after writing ``batch``: append, insert-if-absent or column-selective update."""
    missing = [c for c in columns if c not in batch.columns]
    if missing:
        raise ValueError(f"batch lacks columns: {missing}")
    current = current.select(*columns)
    batch = nan_to_null(batch.select(*columns))
    if not key:
        return current.unionByName(batch)
    if not update:
        return current.unionByName(batch.join(current.select(*key), list(key), "left_anti"))
    incoming = batch.select(*[F.col(c).alias(f"new_{c}") for c in columns])
    on = [F.col(k) == F.col(f"new_{k}") for k in key]
    is_new, is_hit = F.col(key[0]).isNull(), F.col(f"new_{key[0]}").isNotNull()

    def after(name: str) -> Column:
        takes_new = is_new | is_hit if name in update else is_new
        return F.when(takes_new, F.col(f"new_{name}")).otherwise(F.col(name)).alias(name)

    return current.join(incoming, on, "full_outer").select(*[after(c) for c in columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.FloatType | T.DoubleType)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def check_batch_keys(batch: DataFrame, key: Sequence[str]) -> None:
    """A keyed write needs every key present and no key twice within the batch."""
    grouped = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    bad = F.col("n") > 1
    for k in key:
        bad = bad | F.col(k).isNull()
    if not grouped.where(bad).isEmpty():
        raise ValueError(f"batch has missing or repeated keys {list(key)}")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = specs()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, since: C.AsOf = None, until: C.AsOf = None) -> DataFrame:
        """A table; a maintained table that was never written reads as empty.

        ``since`` (inclusive) and ``until`` (exclusive) bound the instant that the table is stored by; days outside
        are not opened.
        """
        spec = self.specs.get(name)
        df = self._stored(name)
        if df is None:
            if spec is None:
                raise ValueError(f"no table {name}")
            return self.spark.createDataFrame([], spec.schema)
        df = df.where(self._within(name, since, until, PARTITION in df.columns))
        return C.conform(df, spec.schema) if spec else df.drop(*([PARTITION] if name in DAILY_MARTS else []))

    def _within(self, name: str, since: C.AsOf, until: C.AsOf, by_day: bool) -> Column:
        instant, day, kept = self._instant(name), F.col(PARTITION).cast("date"), F.lit(True)
        for bound, at_least in ((since, True), (until, False)):
            if bound is not None:
                edge = C.as_of_ts(bound)
                kept = kept & (F.col(instant) >= edge if at_least else F.col(instant) < edge)
                if by_day:
                    kept = kept & (day >= F.to_date(edge) if at_least else day <= F.to_date(edge))
        return kept

    def _instant(self, name: str) -> str | None:
        return self.specs[name].partition_by if name in self.specs else DAILY_MARTS.get(name)

    def exists(self, name: str) -> bool:
        return self._stored(name) is not None

    def _stored(self, name: str) -> DataFrame | None:
        """The files of a table, None where no file is (never written, or truncated); other failures are the caller's to see."""
        try:
            return self.spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def write_mart(self, name: str, df: DataFrame) -> DataFrame:
        """Full refresh of a derived table; returns it read back."""
        if name in DAILY_MARTS:
            self._by_day(df, DAILY_MARTS[name]).mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(name))
        else:
            df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name)

    def write_days(self, name: str, df: DataFrame) -> None:
        """Replace the days that ``df`` has rows of; other days are left alone. ``df`` may read the table itself, and
        have columns beyond the table's."""
        settled = settle(df.drop(PARTITION), name)
        writer = self._by_day(settled, self._instant(name)).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(name))

    def _by_day(self, df: DataFrame, instant: str):
        """A writer of one file for each day and advised size: small days aren't scattered over the tasks that held
        their rows, and a large one is written by many."""
        by_day = df.withColumn(PARTITION, F.to_date(instant)).hint("rebalance", PARTITION)
        return by_day.write.partitionBy(PARTITION)

    def create_views(self, names: Sequence[str], prefix: str = "") -> None:
        for name in names:
            self.read(name).createOrReplaceTempView(f"{prefix}{name}")

    def write_batch(self, name: str, batch: DataFrame) -> None:
        """Append or upsert, as the table's spec says; an empty batch writes nothing."""
        spec = self.specs[name]
        # Files first: asking a lazy batch whether it is empty can cost as much as computing it.
        batch = settle(C.conform(batch, spec.schema), name)
        if batch.isEmpty():
            return
        if not spec.key:
            self._save(spec, nan_to_null(batch), "append")
            return
        check_batch_keys(batch, spec.key)
        merged = merge_rows(self._touched(spec, batch), batch, spec.schema.fieldNames(), spec.key, spec.update)
        # Written aside first: the partitions about to be replaced are the ones being read.
        self._save(spec, settle(merged, name), "overwrite")

    def truncate(self, name: str) -> None:
        """Empty a table."""
        if name in self.specs:
            empty = self.spark.createDataFrame([], self.specs[name].schema)
            self._save(self.specs[name], empty, "overwrite", partitions="static")
        else:
            empty = self.spark.createDataFrame([], self.read(name).schema)
            empty.write.mode("overwrite").parquet(self.path(name))

    def count(self, name: str) -> int:
        return self.read(name).count()

    def _touched(self, spec: TableSpec, batch: DataFrame) -> DataFrame:
        """Rows of the partitions the batch falls into; the other partitions are not read."""
        stored = self._stored(spec.name)
        if stored is None:
            return self.spark.createDataFrame([], spec.schema)
        # Calendar days of one batch: a handful for a load, bounded by the calendar for a backfill.
        # As literals they prune directories at planning time.
        days = [r[0] for r in batch.select(F.to_date(spec.partition_by)).distinct().collect()]
        return C.conform(stored.where(F.col(PARTITION).cast("date").isin(days)), spec.schema)

    def _save(self, spec: TableSpec, df: DataFrame, mode: str, partitions: str = "dynamic") -> None:
        writer = self._by_day(df, spec.partition_by).mode(mode).option("partitionOverwriteMode", partitions)
        writer.parquet(self.path(spec.name))
