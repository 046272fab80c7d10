"""Fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import columns as C
from tidemark.functions.terms import ASSET_TERMS, mention_column
from tidemark.operators.bars import MIN_TICKS_PER_HOUR, hourly_bars, with_bar_deltas
from tidemark.operators.latest import latest_by

PRICE_FACT_COLUMNS = [
    "price_hour_key", "coin_key", "coin_id", "symbol", "event_hour", "date_key", "open", "high", "low", "close",
    "vwap", "avg_spread", "ticks_count", "volume_base_24h", "volume_quote_24h", "trades_count_24h",
    "hour_volume_base_delta", "hour_trades_delta", "hour_return", "dw_updated_at",
]

# Measures a market snapshot carries over from staging unchanged.
SNAPSHOT_MEASURES = [
    "current_price", "market_cap", "market_cap_rank", "fdv", "volume_24h", "high_24h", "low_24h",
    "price_change_24h", "price_change_pct_1h", "price_change_pct_24h", "price_change_pct_7d",
    "market_cap_change_24h", "market_cap_change_pct_24h", "circulating_supply", "total_supply", "max_supply",
    "ath", "ath_change_pct", "ath_date", "atl", "atl_change_pct", "atl_date",
]


def fact_prices_hourly(
    stg_ticks: DataFrame,
    dim_coin: DataFrame,
    min_ticks: int = MIN_TICKS_PER_HOUR,
    as_of: C.AsOf = None,
) -> DataFrame:
    return key_bars(with_bar_deltas(hourly_bars(stg_ticks, min_ticks)), dim_coin, as_of)


def key_bars(bars: DataFrame, dim_coin: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Attach the coin to bars that already carry their deltas.

    Symbols are not unique per coin: a symbol shared by several coins fans out, and one
    without a coin keeps NULL keys. Both are reported by the data-quality checks. The
    dimension is one row per coin; Spark broadcasts it when its measured size allows and
    otherwise falls back to a shuffled join.
    """
    coins = dim_coin.select("coin_key", "coin_id", F.upper("symbol").alias("symbol"))
    return (
        bars.join(coins, "symbol", "left")
        .withColumns(
            {
                "price_hour_key": C.surrogate_key("coin_key", C.hour_text("event_hour")),
                "date_key": C.date_key("event_hour"),
                "dw_updated_at": C.as_of_ts(as_of),
            }
        )
        .select(*PRICE_FACT_COLUMNS)
    )


def fact_market_snapshot(stg_markets: DataFrame, dim_coin: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Newest snapshot per coin and hour."""
    hourly = latest_by(
        stg_markets.select("coin_id", "symbol", "snapshot_hour", *SNAPSHOT_MEASURES, "ingested_at"),
        keys=["coin_id", "snapshot_hour"],
        order=[F.desc("ingested_at"), F.desc("current_price"), F.desc("market_cap")],
    )
    return hourly.join(dim_coin.select("coin_id", "coin_key"), "coin_id", "left").select(
        C.surrogate_key("coin_key", C.hour_text("snapshot_hour")).alias("market_snapshot_key"),
        "coin_key",
        "coin_id",
        "symbol",
        "snapshot_hour",
        C.date_key("snapshot_hour").alias("date_key"),
        *SNAPSHOT_MEASURES,
        C.as_of_ts(as_of).alias("dw_updated_at"),
    )


def posts_daily(stg_posts: DataFrame, terms: Mapping[str, Sequence[str]] = ASSET_TERMS) -> DataFrame:
    """Social activity per day."""
    mentions = [mention_column(s) for s in terms]
    return stg_posts.groupBy(F.to_date("created_date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("reddit_posts_count"),
        F.countDistinct("author").alias("reddit_unique_authors"),
        F.sum("score").alias("reddit_total_score"),
        F.avg("score").cast("decimal(12,2)").alias("reddit_avg_score"),
        F.avg("upvote_ratio").cast("decimal(6,4)").alias("reddit_avg_upvote_ratio"),
        F.sum("num_comments").alias("reddit_total_comments"),
        *[F.count_if(F.col(m)).alias(m) for m in mentions],
    )


def fact_sentiment_daily(
    stg_index: DataFrame,
    stg_posts: DataFrame,
    terms: Mapping[str, Sequence[str]] = ASSET_TERMS,
    as_of: C.AsOf = None,
) -> DataFrame:
    """Index reading and social activity per day, keeping days that have only one of the two.

    Both sides are unique per day, so one full outer join replaces a date union with two left joins.
    """
    index = stg_index.select(
        F.to_date("index_date").alias("date_day"),
        F.col("value").alias("fng_value"),
        F.col("category").alias("fng_category"),
        F.col("sentiment_bucket").alias("fng_bucket"),
        F.col("sentiment_score").alias("fng_score"),
    )
    counts = [
        "reddit_posts_count", "reddit_unique_authors", "reddit_total_score", "reddit_total_comments",
        *[mention_column(s) for s in terms],
    ]
    daily = index.join(posts_daily(stg_posts, terms), "date_day", "full_outer").fillna(0, subset=counts)
    return daily.select(
        C.date_key("date_day").alias("date_key"),
        "date_day",
        "fng_value",
        "fng_category",
        "fng_bucket",
        "fng_score",
        "reddit_posts_count",
        "reddit_unique_authors",
        "reddit_total_score",
        "reddit_avg_score",
        "reddit_avg_upvote_ratio",
        "reddit_total_comments",
        *[mention_column(s) for s in terms],
        C.as_of_ts(as_of).alias("dw_updated_at"),
    )
