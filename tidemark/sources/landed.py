"""Payloads of the periodic feeds, as landed JSON, to typed rows with lineage columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas
from tidemark.functions import columns as C

# Prefix of stored permalinks, and the stored body length of the original loader
# (pass it as ``body_chars`` to reproduce its rows; by default the whole body is kept).
PERMALINK_PREFIX = "https://reddit.com"
ORIGINAL_BODY_CHARS = 2000

# Exchange pair -> market-data coin id.
PAIR_TO_COIN = {
    "BTCUSDT": "bitcoin",
    "ETHUSDT": "ethereum",
    "SOLUSDT": "solana",
    "ADAUSDT": "cardano",
    "XRPUSDT": "ripple",
    "DOGEUSDT": "dogecoin",
    "AVAXUSDT": "avalanche-2",
    "DOTUSDT": "polkadot",
    "MATICUSDT": "matic-network",
    "LINKUSDT": "chainlink",
}

PAYLOADS = {
    "markets": schemas.MARKET_PAYLOAD_DDL,
    "index": schemas.INDEX_PAYLOAD_DDL,
    "posts": schemas.POST_LISTING_DDL,
}


def read_payload(spark: SparkSession, path: str, kind: str, whole_files: bool = False) -> DataFrame:
    """Landed JSON of one feed with its declared schema, one document per line.

    ``whole_files`` reads one document per file instead (a raw response saved as is).
    """
    return spark.read.schema(T.StructType.fromDDL(PAYLOADS[kind])).json(path, multiLine=whole_files)


def _lineage(source: str, dataset: str, ingested_at: C.AsOf) -> list[Column]:
    return [
        C.as_of_ts(ingested_at).alias("_ingested_at"),
        F.lit(source).alias("_source"),
        F.lit(dataset).alias("_dataset"),
    ]


def market_rows(
    payload: DataFrame, ingested_at: C.AsOf = None, source: str = "coingecko", dataset: str = "market_data"
) -> DataFrame:
    """One row per coin; ISO dates parsed, unreadable ones NULL."""
    dates = {c: F.try_to_timestamp(F.col(c)) for c in ("last_updated", "ath_date", "atl_date")}
    return payload.withColumns(dates).select("*", *_lineage(source, dataset, ingested_at))


def index_rows(
    payload: DataFrame, ingested_at: C.AsOf = None, source: str = "fng", dataset: str = "index"
) -> DataFrame:
    """One row per index reading; text numbers and epoch seconds typed."""
    reading = payload.select(F.explode("data").alias("r"))
    return reading.select(
        F.timestamp_seconds(F.col("r.timestamp").cast("long")).alias("index_date"),
        F.col("r.value").cast("int").alias("value"),
        F.col("r.value_classification").alias("category"),
        F.col("r.time_until_update").alias("time_until_update"),
        *_lineage(source, dataset, ingested_at),
    )


def post_rows(
    listing: DataFrame,
    forum: Column | str,
    ingested_at: C.AsOf = None,
    source: str = "reddit",
    dataset: str = "posts",
    body_chars: int | None = None,
) -> DataFrame:
    """One row per listed post; posts without id or creation time are skipped, counters default to 0."""
    post = listing.select(
        (F.lit(forum) if isinstance(forum, str) else forum).alias("subreddit"),
        F.explode("data.children").alias("child"),
    ).select("subreddit", "child.data.*")
    body = F.coalesce("selftext", F.lit(""))

    def or_default(name: str, default) -> Column:
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    return post.where(F.col("id").isNotNull() & F.col("created_utc").isNotNull()).select(
        "id",
        "subreddit",
        or_default("title", ""),
        (body if body_chars is None else F.left(body, F.lit(body_chars))).alias("selftext"),
        "author",
        or_default("score", 0).cast("int").alias("score"),
        or_default("upvote_ratio", 0.0),
        or_default("num_comments", 0).cast("int").alias("num_comments"),
        F.timestamp_seconds("created_utc").alias("created_utc"),
        "url",
        or_default("is_self", False),
        or_default("over_18", False),
        F.concat(F.lit(PERMALINK_PREFIX), F.coalesce("permalink", F.lit(""))).alias("permalink"),
        *_lineage(source, dataset, ingested_at),
    )


def to_landing(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with lineage columns to the landing schema: absent columns NULL, extra ones dropped."""
    return C.conform(rows.withColumnRenamed("_ingested_at", "ingested_at"), schema)


def tracked_pairs(spark: SparkSession, setting: str) -> DataFrame:
    """Pairs named in a comma-separated setting: trimmed, upper-cased, blanks dropped."""
    names = F.filter(F.transform(F.split(F.lit(setting), ","), lambda s: F.upper(F.trim(s))), lambda s: s != "")
    return spark.range(1).select(F.posexplode(names).alias("position", "pair"))


def tracked_coins(spark: SparkSession, setting: str, mapping: Mapping[str, str] = PAIR_TO_COIN) -> DataFrame:
    """Coin ids of the tracked pairs; pairs without a known coin are dropped."""
    coin = C.pick(F.col("pair"), {p: F.lit(c) for p, c in mapping.items()}, F.lit(None))
    return tracked_pairs(spark, setting).withColumn("coin_id", coin).where(F.col("coin_id").isNotNull())
