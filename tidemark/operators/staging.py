"""Cleaned, typed views of the landing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import columns as C
from tidemark.functions.terms import ASSET_TERMS, mention_flags
from tidemark.operators.latest import latest_by

QUOTE = "USDT"  # fixed value: quote currency of every tracked pair

# Upper bounds of the index buckets.
INDEX_BUCKETS = [(24, "extreme_fear"), (44, "fear"), (54, "neutral"), (74, "greed")]
INDEX_TOP_BUCKET = "extreme_greed"

PREVIEW_CHARS = 500  # fixed value: length of the display preview column; analysis reads full_text

# Landing name -> staged name of the market snapshot columns.
MARKET_COLUMNS = {
    "id": "coin_id",
    "symbol": "symbol",
    "name": "coin_name",
    "image": "image_url",
    "current_price": "current_price",
    "market_cap": "market_cap",
    "market_cap_rank": "market_cap_rank",
    "fully_diluted_valuation": "fdv",
    "total_volume": "volume_24h",
    "high_24h": "high_24h",
    "low_24h": "low_24h",
    "price_change_24h": "price_change_24h",
    "price_change_percentage_24h": "price_change_pct_24h",
    "price_change_percentage_1h_in_currency": "price_change_pct_1h",
    "price_change_percentage_7d_in_currency": "price_change_pct_7d",
    "market_cap_change_24h": "market_cap_change_24h",
    "market_cap_change_percentage_24h": "market_cap_change_pct_24h",
    "circulating_supply": "circulating_supply",
    "total_supply": "total_supply",
    "max_supply": "max_supply",
    "ath": "ath",
    "ath_change_percentage": "ath_change_pct",
    "ath_date": "ath_date",
    "atl": "atl",
    "atl_change_percentage": "atl_change_pct",
    "atl_date": "atl_date",
    "last_updated": "last_updated",
    "ingested_at": "ingested_at",
}


def stg_ticks(ticks: DataFrame) -> DataFrame:
    """Valid ticks with base/quote split, time buckets and bid-ask spread.

    The filter reads landing columns as they are, so it reaches the Parquet scan;
    arithmetic is done in double (decimal products would lose scale).
    """
    is_pair = F.col("symbol").endswith(QUOTE)
    kept = ticks.where((F.col("price") > 0) & (F.col("volume_base") >= 0) & F.col("symbol").isNotNull())
    typed = kept.select(
        "symbol",
        F.when(is_pair, F.expr(f"left(symbol, length(symbol) - {len(QUOTE)})"))
        .otherwise(F.col("symbol"))
        .alias("base_asset"),
        F.when(is_pair, F.lit(QUOTE)).alias("quote_asset"),
        "event_time",
        F.date_trunc("minute", "event_time").alias("event_minute"),
        F.date_trunc("hour", "event_time").alias("event_hour"),
        F.date_trunc("day", "event_time").alias("event_date"),
        *[F.col(c).cast("double").alias(c) for c in ("price", "price_change_pct", "volume_base", "volume_quote")],
        "trades_count",
        F.col("bid").cast("double").alias("bid"),
        F.col("ask").cast("double").alias("ask"),
        "ingested_at",
    )
    spread = F.col("ask") - F.col("bid")
    return typed.withColumns(
        {"spread": spread, "spread_pct": F.when(F.col("bid") > 0, spread / F.col("bid") * 100)}
    )


def stg_markets(markets: DataFrame) -> DataFrame:
    """Priced market snapshots under short names, with hour and day buckets."""
    renamed = {new: F.col(old) for old, new in MARKET_COLUMNS.items()}
    renamed["symbol"] = F.upper("symbol")
    return (
        markets.where(F.col("current_price").isNotNull())
        .select(*[expr.alias(name) for name, expr in renamed.items()])
        .withColumns(
            {
                "snapshot_hour": F.date_trunc("hour", "ingested_at"),
                "snapshot_date": F.date_trunc("day", "ingested_at"),
            }
        )
    )


def stg_index(index: DataFrame) -> DataFrame:
    """One index reading per day (the last ingested), bucketed and scaled to [-1, 1]."""
    daily = latest_by(
        index.select(
            F.date_trunc("day", "index_date").alias("index_date"), "value", "category", "ingested_at"
        ),
        keys=["index_date"],
        order=[F.desc("ingested_at"), F.desc("value")],
    )
    return daily.select(
        "index_date",
        "value",
        F.lower("category").alias("category"),
        C.label_at_most(F.col("value"), INDEX_BUCKETS, INDEX_TOP_BUCKET).alias("sentiment_bucket"),
        F.round((F.col("value") - 50) / F.lit(50.0), 4).alias("sentiment_score"),
        "ingested_at",
    )


def stg_posts(posts: DataFrame, terms: Mapping[str, Sequence[str]] = ASSET_TERMS) -> DataFrame:
    """Titled, safe posts with a preview, the whole text and one mention flag per tracked asset."""
    body = F.coalesce("selftext", F.lit(""))
    shaped = posts.where(F.col("title").isNotNull() & ~F.col("over_18")).select(
        "id",
        F.lower("subreddit").alias("subreddit"),
        "title",
        "selftext",
        F.left(body, F.lit(PREVIEW_CHARS)).alias("selftext_preview"),
        "author",
        "score",
        "upvote_ratio",
        "num_comments",
        "created_utc",
        "url",
        "is_self",
        "over_18",
        "permalink",
        "ingested_at",
        F.date_trunc("hour", "created_utc").alias("created_hour"),
        F.date_trunc("day", "created_utc").alias("created_date"),
        F.concat("title", F.lit(" "), body).alias("full_text"),
    )
    return shaped.select("*", *mention_flags(F.col("full_text"), terms))


def stg_sentiment(sentiment: DataFrame) -> DataFrame:
    """Scored posts with day / hour buckets and a signed label."""
    sign = C.pick(F.col("sentiment_label"), {"positive": F.lit(1), "negative": F.lit(-1)}, F.lit(0))
    return sentiment.select(
        "post_id",
        "subreddit",
        "created_utc",
        F.to_date("created_utc").alias("created_date"),
        F.date_trunc("hour", "created_utc").alias("created_hour"),
        "compound",
        "pos",
        "neu",
        "neg",
        "sentiment_label",
        sign.alias("sentiment_score"),
        "text_length",
        "model_version",
        "scored_at",
    )


def stg_anomalies(anomalies: DataFrame) -> DataFrame:
    """Detections with calendar columns and an any-detector flag."""
    return anomalies.select(
        "symbol",
        "event_hour",
        F.to_date("event_hour").alias("event_date"),
        C.date_key("event_hour").alias("date_key"),
        "close",
        "hour_return",
        "volume_base",
        "return_zscore",
        "is_anomaly_zscore",
        "zscore_threshold",
        "iforest_score",
        "is_anomaly_iforest",
        "is_anomaly_consensus",
        (F.col("is_anomaly_zscore") | F.col("is_anomaly_iforest")).alias("is_anomaly_any"),
        "model_version",
        "detected_at",
    )
