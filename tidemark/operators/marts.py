"""Analytics marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import columns as C
from tidemark.functions.terms import ASSET_TERMS, mention_column
from tidemark.operators.latest import latest_by

# Fixed values of the movers mart.
MAX_MARKET_CAP_RANK = 200
TOP_MOVERS = 10


def last_snapshot_per_day(snapshots: DataFrame) -> DataFrame:
    """Closing snapshot of every coin and day."""
    return latest_by(snapshots, keys=["date_key", "coin_key"], order=[F.desc("snapshot_hour"), F.asc("coin_id")])


def top_movers_daily(
    snapshots: DataFrame,
    max_rank: int = MAX_MARKET_CAP_RANK,
    top: int = TOP_MOVERS,
    as_of: C.AsOf = None,
) -> DataFrame:
    """Gainer and loser ranks per day among the leading coins.

    The rank filter comes before the day's last snapshot is chosen and the NULL-change
    filter after it; the order changes the result. A ranking window holds one row per
    leading coin of a day.
    """
    leading = snapshots.where(F.col("market_cap_rank") <= max_rank).select(
        "date_key", "coin_key", "coin_id", "symbol", "market_cap", "market_cap_rank", "current_price",
        "price_change_pct_24h", "volume_24h", "snapshot_hour",
    )
    closing = last_snapshot_per_day(leading).drop("snapshot_hour").where(F.col("price_change_pct_24h").isNotNull())
    by_day = Window.partitionBy("date_key")
    ranked = closing.withColumns(
        {
            "rank_gainer": F.rank().over(by_day.orderBy(F.desc_nulls_last("price_change_pct_24h"))),
            "rank_loser": F.rank().over(by_day.orderBy(F.asc_nulls_last("price_change_pct_24h"))),
        }
    )
    return ranked.withColumns(
        {
            "is_top10_gainer": F.col("rank_gainer") <= top,
            "is_top10_loser": F.col("rank_loser") <= top,
            "dw_updated_at": C.as_of_ts(as_of),
        }
    )


def mentions_long(sentiment: DataFrame, terms: Mapping[str, Sequence[str]] = ASSET_TERMS) -> DataFrame:
    """Wide mention columns to one row per (day, symbol), in a single scan."""
    columns = [mention_column(s) for s in terms]
    symbols = {mention_column(s): F.lit(s) for s in terms}
    ids = ["date_key", "date_day", "fng_value", "fng_bucket", "fng_score"]
    return (
        sentiment.select(*ids, *columns)
        .unpivot(ids, columns, "mention", "mentions_count")
        .withColumn("symbol", C.pick(F.col("mention"), symbols, F.lit(None)))
        .drop("mention")
    )


def social_vs_price(
    sentiment: DataFrame,
    snapshots: DataFrame,
    terms: Mapping[str, Sequence[str]] = ASSET_TERMS,
    as_of: C.AsOf = None,
) -> DataFrame:
    """Mentions of an asset next to its price move of the same and the following row's day.

    The lead window holds one symbol's days (365 a year, times the coins sharing the symbol).
    """
    closing = last_snapshot_per_day(
        snapshots.select(
            "date_key", "coin_key", "coin_id", "symbol", "current_price", "price_change_pct_24h", "market_cap",
            "market_cap_rank", "snapshot_hour",
        )
    ).drop("snapshot_hour")
    joined = mentions_long(sentiment, terms).join(closing, ["date_key", "symbol"], "left")
    series = Window.partitionBy("symbol").orderBy("date_key", "coin_id")
    return joined.select(
        "date_key",
        "date_day",
        "coin_key",
        "coin_id",
        "symbol",
        "mentions_count",
        "current_price",
        "price_change_pct_24h",
        F.lead("price_change_pct_24h").over(series).alias("lead_1d_return"),
        "market_cap",
        "market_cap_rank",
        "fng_value",
        "fng_bucket",
        "fng_score",
        C.as_of_ts(as_of).alias("dw_updated_at"),
    )


def sentiment_share_daily(sentiment: DataFrame, avg_scale: str = "decimal(8,4)") -> DataFrame:
    """Scored posts per day: count, mean compound and share of positive / negative labels."""

    def share(label: str):
        hit = F.when(F.col("sentiment_label") == label, 1.0).otherwise(0.0)
        return F.avg(hit).cast("decimal(6,4)")

    return sentiment.groupBy(F.to_date("created_utc").alias("date_day")).agg(
        F.count(F.lit(1)).alias("posts_scored"),
        F.avg("compound").cast(avg_scale).alias("vader_compound_avg"),
        share("positive").alias("vader_pct_positive"),
        share("negative").alias("vader_pct_negative"),
    )


def anomaly_alerts(
    stg_anomalies: DataFrame,
    prices: DataFrame,
    snapshots: DataFrame,
    sentiment_daily: DataFrame,
    scored_posts: DataFrame,
    terms: Mapping[str, Sequence[str]] = ASSET_TERMS,
    as_of: C.AsOf = None,
) -> DataFrame:
    """Flagged hours with price, market and mood context.

    Flagged hours are few, so they drive all four left joins; every right side is unique
    per key except the closing snapshot, which fans out when coins share a symbol.
    """
    flagged = stg_anomalies.where("is_anomaly_any").drop("close", "hour_return", "volume_base", "event_date")
    bars = prices.select(
        "symbol", "event_hour", "coin_key", "coin_id", "open", "high", "low", "close", "vwap", "hour_return",
        "hour_volume_base_delta", "avg_spread", "ticks_count",
    )
    closing = last_snapshot_per_day(
        snapshots.select(
            "coin_key", "coin_id", "symbol", "date_key", "market_cap", "market_cap_rank", "price_change_pct_24h",
            "snapshot_hour",
        )
    ).drop("coin_key", "coin_id", "snapshot_hour")
    mood = sentiment_daily.select("date_key", "fng_value", "fng_bucket", *[mention_column(s) for s in terms])
    scored = sentiment_share_daily(scored_posts).select(
        C.date_key("date_day").alias("date_key"),
        F.col("posts_scored").alias("reddit_scored_count"),
        "vader_compound_avg",
        "vader_pct_positive",
        "vader_pct_negative",
    )
    mentions = C.pick(F.col("symbol"), {s: F.col(mention_column(s)) for s in terms}, F.lit(0))
    return (
        flagged.join(bars, ["symbol", "event_hour"], "left")
        .join(closing, ["symbol", "date_key"], "left")
        .join(mood, "date_key", "left")
        .join(scored, "date_key", "left")
        .select(
            "symbol",
            "event_hour",
            "date_key",
            "coin_key",
            "coin_id",
            "open",
            "high",
            "low",
            "close",
            "vwap",
            "hour_return",
            "hour_volume_base_delta",
            "avg_spread",
            "ticks_count",
            "return_zscore",
            "zscore_threshold",
            "is_anomaly_zscore",
            "iforest_score",
            "is_anomaly_iforest",
            "is_anomaly_consensus",
            F.abs(F.coalesce("return_zscore", F.lit(0.0))).alias("severity_score"),
            "market_cap",
            "market_cap_rank",
            "price_change_pct_24h",
            "fng_value",
            "fng_bucket",
            mentions.alias("reddit_mentions_day"),
            "reddit_scored_count",
            "vader_compound_avg",
            "vader_pct_positive",
            "vader_pct_negative",
            F.col("model_version").alias("anomaly_model_version"),
            "detected_at",
            C.as_of_ts(as_of).alias("dw_updated_at"),
        )
    )
