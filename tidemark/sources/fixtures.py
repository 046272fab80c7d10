"""Adapters: the landing tables derived from the generated test tables.

Pure projections and small aggregates of ``events``, ``documents`` and ``labels``; they keep
every row. The remainders below only spread values over categories, they filter nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions import columns as C
from tidemark.functions.lexicon_rules import Phrases

# Evaluation instant of all fixture queries: just past the last event.
AS_OF = "2024-01-31 00:00:00"

MIN_TICKS = 2  # the fixture is thin: ten ticks an hour would keep almost nothing at small scale

# Words that do occur in the generated prose, standing in for asset names.
TERMS = {
    "CLICK": ("worthless", "this"),
    "VIEW": ("from",),
    "ERROR": ("are",),
    "PURCHASE": ("und", "der"),
    "SIGNUP": ("avec", "très"),
    "OTHER": ("que",),
}

# Word valences for the generated prose.
LEXICON = {
    "the": 0.5, "of": -0.4, "and": 0.3, "to": -0.2, "worthless": -2.5, "is": 0.9, "that": -0.7, "der": 0.4,
    "die": -0.6, "une": 0.8, "la": -0.3, "el": 0.6, "en": 0.2, "les": -1.1, "by": 1.3,
}

NEGATIONS = ("from", "not", "sans", "von")
BOOSTERS = {"this": 0.293, "are": 0.293, "que": -0.293, "und": -0.293}
# Rules on several words, by words that do follow each other in the prose.
PHRASES = Phrases(
    least="in", least_after=("is", "of"), strengthens={"from": ("are", "and")}, idle={"not": ("the",), "von": ("der", "die")},
    no="is", no_over=("and", "of"), kind=("by", "the"),
    idioms={"of the": -1.4, "to the": 2.2, "die der": -0.9, "la la": 1.1, "the and of": 2.0, "en la": 0.0},
    boosters={"are the": 0.31, "and of": -0.27, "the is and": 0.4},
)

# A small stored forest over (hour return, volume, spread): tree, node, feature, threshold, low, high, path.
# Path lengths are sums of powers of two, so totals are exact in any order.
FOREST_SAMPLED = 16
FOREST_NODES = (
    (0, 0, 0, -0.01012, 1, 2, 0.0), (0, 1, 0, -0.0131, 3, 4, 0.0), (0, 2, 0, 0.01013, 5, 6, 0.0),
    (0, 3, 0, 0.0, 3, 3, 1.5), (0, 4, 0, 0.0, 4, 4, 2.25), (0, 5, 0, 0.0, 5, 5, 6.5), (0, 6, 0, 0.0, 6, 6, 2.0),
    (1, 0, 1, -60.37, 1, 2, 0.0), (1, 1, 1, 0.0, 1, 1, 1.75), (1, 2, 1, 57.41, 3, 4, 0.0),
    (1, 3, 1, 0.0, 3, 3, 5.25), (1, 4, 2, 2.26137, 5, 6, 0.0), (1, 5, 0, 0.0, 5, 5, 2.5), (1, 6, 0, 0.0, 6, 6, 1.25),
    (2, 0, 2, 2.25391, 1, 2, 0.0), (2, 1, 0, 0.0, 1, 1, 3.125), (2, 2, 0, 0.00417, 3, 4, 0.0),
    (2, 3, 0, 0.0, 3, 3, 4.5), (2, 4, 1, 12.77, 5, 6, 0.0), (2, 5, 0, 0.0, 5, 5, 2.75), (2, 6, 0, 0.0, 6, 6, 3.5),
)


def stored_forest(symbols: DataFrame) -> DataFrame:
    """The stored forest's nodes for each symbol of a frame."""
    fields = ("tree", "node", "feature", "threshold", "low", "high", "path")
    nodes = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, row)]) for row in FOREST_NODES])
    return symbols.select("symbol").distinct().select("symbol", F.lit(FOREST_SAMPLED).alias("sampled"), F.inline(nodes))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("value") + 1000  # keeps hourly returns within some percent
    return _events(spark, sf_dir).select(
        F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"),
        F.col("ts").alias("event_time"),
        price.alias("price"),
        (F.col("value") - 20).alias("price_change_pct"),
        F.col("k").alias("volume_base"),
        (price * F.col("k")).alias("volume_quote"),
        F.col("user_id").alias("trades_count"),
        (price * 0.998765432187).alias("bid"),
        (price * 1.001234567891).alias("ask"),
        F.col("ts").alias("ingested_at"),
    )


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """150 coins: one per event type and user class; class 0 carries the plain symbol."""
    value, k = F.col("value"), F.col("k")
    klass = F.col("user_id") % 30
    coin = F.concat("event_type", F.lit("-"), klass)
    change = F.when(k != 99, value - 20)
    shaped = _events(spark, sf_dir).select(
        coin.alias("id"),
        F.when(klass == 0, F.col("event_type")).otherwise(coin).alias("symbol"),
        F.concat(F.lit("Coin "), coin).alias("name"),
        F.concat(F.lit("img/"), coin).alias("image"),
        value.alias("current_price"),
        (value * 1e6).alias("market_cap"),
        F.when(k != 0, 1 + (F.col("event_id") * 7) % 300).cast("int").alias("market_cap_rank"),
        (value * 2e6).alias("fully_diluted_valuation"),
        (value * k * 1000).alias("total_volume"),
        (value * 1.25).alias("high_24h"),
        (value * 0.75).alias("low_24h"),
        (value / 4).alias("price_change_24h"),
        change.alias("price_change_percentage_24h"),
        (k / 4 - 12).alias("price_change_percentage_1h_in_currency"),
        change.alias("price_change_percentage_24h_in_currency"),
        (value * 2 - 40).alias("price_change_percentage_7d_in_currency"),
        (value * 1e4).alias("market_cap_change_24h"),
        (k / 2).alias("market_cap_change_percentage_24h"),
        (F.col("user_id") * 1000.0).alias("circulating_supply"),
        (F.col("user_id") * 2000.0).alias("total_supply"),
        F.when(k > 50, F.col("user_id") * 3000.0).alias("max_supply"),
        (value * 4).alias("ath"),
        F.lit(-75.0).alias("ath_change_percentage"),
        F.col("ts").alias("ath_date"),
        (value / 4).alias("atl"),
        F.lit(300.0).alias("atl_change_percentage"),
        F.col("ts").alias("atl_date"),
        F.col("ts").alias("last_updated"),
        F.col("ts").alias("ingested_at"),
    )
    # ANSI %: user_id and event_id are never negative.
    return shaped


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several readings per day (one per event type), so that only the last one may survive staging."""
    cents = F.round(F.col("value") * 100).cast("long")
    reading = (
        _events(spark, sf_dir)
        .groupBy(F.date_trunc("day", "ts").alias("day"), "event_type")
        .agg(
            F.sum(cents).alias("cents"),
            F.count(F.lit(1)).alias("n"),
            F.min("ts").alias("index_date"),
            F.max("ts").alias("ingested_at"),
        )
        .withColumn("value", F.expr("least(100, cents div (100 * n))").cast("int"))
    )
    return reading.select(
        "index_date",
        "value",
        C.label_at_most(F.col("value"), [(24, "Extreme Fear"), (54, "Neutral")], "Greed").alias("category"),
        F.lit("0").alias("time_until_update"),
        "ingested_at",
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per document: first line as title, the rest as body, so title + body is the whole text."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("unsafe"))
    text = F.col("text")
    title = F.substring_index(text, "\n", 1)
    created = F.timestamp_seconds(F.lit(1704067200) + ((F.col("doc_id") * 41) % 43200) * 60)
    return (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").cast("string").alias("id"),
            F.upper("source").alias("subreddit"),
            title.alias("title"),
            F.substr(text, F.length(title) + 2).alias("selftext"),
            F.concat_ws("-", "source", "lang").alias("author"),
            (F.col("n_chars") % 500 - 50).cast("int").alias("score"),
            ((F.col("n_chars") % 64) / 64).alias("upvote_ratio"),
            (F.col("doc_id") % 37).cast("int").alias("num_comments"),
            created.alias("created_utc"),
            F.concat(F.lit("https://example.org/"), "doc_id").alias("url"),
            F.lit(True).alias("is_self"),
            # documents without a label are posts like any other
            F.coalesce("unsafe", F.lit(False)).alias("over_18"),
            F.concat(F.lit("/p/"), "doc_id").alias("permalink"),
            created.alias("ingested_at"),
        )
    )


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON.items()), "word STRING, valence DOUBLE")


def landing_schemas() -> dict:
    """Declared schema of every landing table."""
    return {
        "ticks": schemas.ticks(),
        "markets": schemas.markets(),
        "index": schemas.index(),
        "posts": schemas.posts(),
    }
