"""Live ticks: exchange ticker -> normalised message -> tick table, as Structured Streaming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import columns as C

# Ticker field -> message field. Numbers arrive as text.
TICKER_FIELDS = {
    "symbol": "s",
    "event_time": "E",
    "price": "c",
    "price_change": "p",
    "price_change_pct": "P",
    "volume_base": "v",
    "volume_quote": "q",
    "trades_count": "n",
    "bid": "b",
    "ask": "a",
    "open": "o",
    "high": "h",
    "low": "l",
}

# Fields a message must carry, and those among them the tick table does not accept NULL for.
REQUIRED_FIELDS = [
    "symbol", "event_time", "price", "price_change_pct", "volume_base", "volume_quote", "trades_count", "bid", "ask",
]
NOT_NULL_FIELDS = ["symbol", "event_time", "price"]

# A micro-batch is due at so many records or seconds; the partition count of the topic.
BATCH_ROWS = 500
BATCH_SECONDS = 5
TOPIC_PARTITIONS = 6
# The most records one micro-batch takes of a backlog.
BACKLOG_ROWS = 1000 * BATCH_ROWS

COMMITS_DDL = "symbol STRING, event_hour TIMESTAMP, consumed BIGINT, inserted BIGINT, dead_letters BIGINT, batch_id BIGINT"


def _message_type() -> T.StructType:
    return T.StructType.fromDDL(schemas.TICK_MESSAGE_DDL)


def normalize_tickers(raw: DataFrame, value: str = "value") -> DataFrame:
    """Exchange payloads, with or without their ``data`` envelope, as the 13 named, typed fields.

    Rows whose payload lacks a field or holds a non-number come out with that field NULL;
    the reader of the topic turns them into dead letters.
    """
    outer = F.from_json(F.col(value).cast("string"), schemas.TICKER_MAP_DDL)
    parsed = raw.withColumn("_outer", outer)
    inner = F.from_json(F.try_element_at("_outer", F.lit("data")), schemas.TICKER_MAP_DDL)
    parsed = parsed.withColumn("_ticker", F.coalesce(inner, "_outer"))
    message = _message_type()
    typed = [
        F.try_element_at("_ticker", F.lit(short)).try_cast(message[name].dataType).alias(name)
        for name, short in TICKER_FIELDS.items()
    ]
    return parsed.select(*typed)


def to_messages(ticks: DataFrame, keep: Sequence[str] = (), partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Topic records: symbol as key, JSON as value, and the topic partition, which a symbol never changes."""
    fields = [c for c in TICKER_FIELDS if c in ticks.columns]
    partition = F.pmod(F.hash("symbol"), F.lit(partitions)).cast("int")
    return ticks.select(
        F.col("symbol").alias("key"), F.to_json(F.struct(*fields)).alias("value"), partition.alias("partition"), *keep
    )


def publish(
    messages: DataFrame, fmt: str = "kafka", options: Mapping[str, str] | None = None, order: Sequence[str] = ()
) -> None:
    """Write topic records in one batch. For ``kafka`` pass the servers and topic as options.

    With ``order`` each topic partition is written by one task in the order of these columns, which are not
    sent: a symbol's records arrive in their order. Records are sorted in ranges, by as many tasks as there are; the
    task that writes puts compressed runs in order, not records.
    """
    if order:
        messages = _unpacked(_packed(messages, order).repartition("partition").sortWithinPartitions("partition", *order, _RUN), messages, order)
    messages.write.format(fmt).mode("append").options(**(options or {})).save()


_RUN, _RECORDS = "_run", "_records"


def _packed(messages: DataFrame, order: Sequence[str]) -> DataFrame:
    """Runs of sorted records of one topic partition: the order columns of the first record, a running number (equal
    values never lie in two ranges) and the records as compressed Arrow data."""
    fields = {f.name: f for f in messages.schema}
    sent = [c for c in fields if c not in order]
    head = ["partition", *[c for c in order if c != "partition"]]

    def step(batches):
        run = 0
        for batch in batches:
            at = batch.column("partition").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                sink = pa.BufferOutputStream()
                records = part.select(sent)
                with pa.ipc.new_stream(sink, records.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(records)
                first = [part.column(c).slice(0, 1) for c in head]
                data = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([*first, pa.array([run], pa.int64()), data], names=[*head, _RUN, _RECORDS])
                run += 1

    kept = T.StructType([fields[c] for c in head]).add(_RUN, "long").add(_RECORDS, "binary")
    ranges = messages.repartitionByRange("partition", *order).sortWithinPartitions("partition", *order)
    return ranges.mapInArrow(step, kept)


def _unpacked(runs: DataFrame, messages: DataFrame, order: Sequence[str]) -> DataFrame:
    def step(batches):
        for batch in batches:
            for run in batch.column(0):
                yield from pa.ipc.open_stream(run.as_buffer())

    return runs.select(_RECORDS).mapInArrow(step, messages.drop(*order).schema)


def admission(fmt: str, rows_per_file: int = BATCH_ROWS) -> dict[str, str]:
    """What a micro-batch takes. The topic hands out a batch once ``BATCH_ROWS`` records wait or ``BATCH_SECONDS`` have
    passed, and at most ``BACKLOG_ROWS`` of a backlog; file sources count files, taken to hold ``rows_per_file``."""
    if fmt == "kafka":
        return {
            "minOffsetsPerTrigger": str(BATCH_ROWS),
            "maxTriggerDelay": f"{BATCH_SECONDS}s",
            "maxOffsetsPerTrigger": str(BACKLOG_ROWS),
        }
    return {"maxFilesPerTrigger": str(max(1, BATCH_ROWS // rows_per_file))}


def read_messages(spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None) -> DataFrame:
    """Stream of topic records with a ``value`` column; any source format that yields one will do. Options given
    win over the bounds of :func:`admission`."""
    defaults = admission(fmt) | ({"startingOffsets": "earliest"} if fmt == "kafka" else {})
    return spark.readStream.format(fmt).options(**{**defaults, **(options or {})}).load()


def decode(messages: DataFrame, ingested_at: C.AsOf = None) -> DataFrame:
    """Tick columns plus ``reason``: NULL for a good message, else why it is a dead letter."""
    text = F.col("value").cast("string")
    keys = F.json_object_keys(text)
    lacking = F.array_except(F.array(*[F.lit(f) for f in REQUIRED_FIELDS]), keys)
    m = F.from_json(text, _message_type())
    parsed = messages.select(text.alias("value"), keys.alias("_keys"), lacking.alias("_lacking"), m.alias("m"))
    absent_value = F.lit(False)
    for name in NOT_NULL_FIELDS:
        absent_value = absent_value | F.col(f"m.{name}").isNull()
    reason = (
        F.when(F.col("_keys").isNull(), "invalid_json")
        .when(F.size("_lacking") > 0, "missing_field")
        .when(absent_value, "bad_value")
    )
    return parsed.select(
        "value",
        reason.alias("reason"),
        F.col("m.symbol").alias("symbol"),
        F.timestamp_millis("m.event_time").alias("event_time"),
        *[F.col(f"m.{f}").alias(f) for f in REQUIRED_FIELDS if f not in ("symbol", "event_time")],
        C.as_of_ts(ingested_at).alias("ingested_at"),
    )


def good_ticks(decoded: DataFrame) -> DataFrame:
    return C.conform(decoded.where(F.col("reason").isNull()), schemas.ticks())


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select("value", "reason", "ingested_at")


def counters() -> list[Column]:
    """Figures observed per micro-batch."""
    return [
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(F.col("reason").isNull()).alias("inserted"),
        F.count_if(F.col("reason").isNotNull()).alias("dead_letters"),
    ]


def ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    ingested_at: C.AsOf = None,
    available_now: bool = False,
    seconds: int = BATCH_SECONDS,
) -> StreamingQuery:
    """Start the consumer: good messages to ``root/ticks``, the rest to ``root/dead_letters``.

    Files carry the batch id as a partition and a repeated batch overwrites its own files
    only, so a restart after a failed batch neither loses nor doubles rows. A batch ends with its commit: the
    symbols and hours it touched with their counts (:func:`read_commits`).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = batch.persist()
        try:
            _save(good_ticks(decoded).withColumn("dt", F.to_date("event_time")), f"{root}/ticks", batch_id, ["dt"])
            _save(dead_letters(decoded), f"{root}/dead_letters", batch_id, [])
            _save(_commit(decoded), f"{root}/commits", batch_id, [])
        finally:
            decoded.unpersist()

    writer = (
        decode(messages, ingested_at)
        .observe("tick_counters", *counters())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName("tick_ingest")
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def _commit(decoded: DataFrame) -> DataFrame:
    """Counts per symbol and hour of the good messages, and one row without either for the rest."""
    good = F.col("reason").isNull()
    hour = F.date_trunc("hour", "event_time")
    groups = decoded.groupBy(F.when(good, F.col("symbol")).alias("symbol"), F.when(good, hour).alias("event_hour"))
    return groups.agg(*counters()).coalesce(1)


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, event_hour, consumed, inserted, dead_letters, batch_id) of every finished batch."""
    return spark.read.schema(COMMITS_DDL).parquet(f"{root}/commits")


def batch_counters(spark: SparkSession, root: str) -> DataFrame:
    """Messages consumed, inserted and refused by every batch ever finished, unlike a query's recent progress."""
    sums = [F.sum(c).alias(c) for c in ("consumed", "inserted", "dead_letters")]
    return read_commits(spark, root).groupBy("batch_id").agg(*sums)


def _save(df: DataFrame, path: str, batch_id: int, partitions: list[str]) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "batch_id")
        .parquet(path)
    )


def read_ticks(spark: SparkSession, root: str) -> DataFrame:
    return C.conform(spark.read.schema(_with(schemas.ticks(), "dt DATE, batch_id BIGINT")).parquet(f"{root}/ticks"), schemas.ticks())


def read_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType.fromDDL("value STRING, reason STRING, ingested_at TIMESTAMP, batch_id BIGINT")
    return spark.read.schema(schema).parquet(f"{root}/dead_letters").drop("batch_id")


def _with(schema: T.StructType, extra_ddl: str) -> T.StructType:
    return T.StructType([*schema.fields, *T.StructType.fromDDL(extra_ddl).fields])


def drain(query: StreamingQuery) -> None:
    """Process what has arrived, then stop: the final flush of an orderly shutdown."""
    query.processAllAvailable()
    query.stop()


def throughput(query: StreamingQuery) -> list[dict]:
    """Counters and rate of the recent micro-batches."""
    report = []
    for progress in query.recentProgress:
        observed = progress["observedMetrics"].get("tick_counters") if progress["observedMetrics"] else None
        entry = {"batch_id": progress["batchId"], "rows_per_second": progress["processedRowsPerSecond"]}
        if observed is not None:
            entry.update(observed.asDict())
        report.append(entry)
    return report
