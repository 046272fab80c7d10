"""Reporting layer: the stable columns consumers see. They read these views, never the marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import columns as C
from tidemark.operators.latest import latest_by
from tidemark.operators.marts import sentiment_share_daily

# Severity cut points.
SEVERITY_STEPS = [(5, "Critical"), (3, "High"), (1, "Medium")]
SEVERITY_FLOOR = "Low"

PRICE_IMPORT_DAYS = 14  # fixed value: history kept by the price import


def one_row(parts: Sequence[DataFrame]) -> DataFrame:
    """Side-by-side columns of single-row frames as one row; an empty part leaves NULLs.

    A union of a handful of rows and one aggregate; no cross join.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def kpi_latest(
    ticks: DataFrame,
    alerts: DataFrame,
    sentiment_daily: DataFrame,
    scored_posts: DataFrame,
    snapshots: DataFrame,
    as_of: C.AsOf = None,
) -> DataFrame:
    """Executive figures of the last 24 hours, one row."""
    now, day_ago = C.as_of_ts(as_of), C.ago(as_of, 24, "hours")
    stream = (
        ticks.where(F.col("event_time") >= day_ago)
        .agg(
            F.countDistinct("symbol").alias("symbols_with_ticks_24h"),
            F.max("event_time").alias("last_tick_at"),
        )
        .withColumn("minutes_since_last_tick", F.round(C.minutes_between(now, F.col("last_tick_at")), 2))
    )
    flagged = alerts.where(F.col("event_hour") >= day_ago).agg(
        F.count(F.lit(1)).alias("anomaly_events_24h"),
        F.count_if("is_anomaly_consensus").alias("anomaly_events_consensus_24h"),
        F.max("severity_score").alias("max_severity_24h"),
    )
    index = (
        sentiment_daily.where(F.col("fng_value").isNotNull())
        .select("fng_value", "fng_bucket", F.col("date_day").alias("fng_as_of"))
        .orderBy(F.desc("fng_as_of"))
        .limit(1)
    )
    mood = scored_posts.where(F.col("created_utc") >= day_ago).agg(
        F.avg("compound").cast("decimal(6,4)").alias("vader_compound_avg_24h"),
        F.count(F.lit(1)).alias("reddit_posts_scored_24h"),
    )
    market = (
        snapshots.groupBy("coin_id")
        .agg(F.max_by("market_cap", "snapshot_hour").alias("market_cap"))
        .agg(F.sum("market_cap").cast("decimal(30,2)").alias("total_market_cap_tracked"))
    )
    return one_row([stream, flagged, index, mood, market]).withColumn("refreshed_at", now)


def price_hourly(prices: DataFrame, dim_coin: DataFrame, pct_scale: int = 1) -> DataFrame:
    """Hourly bars with a readable coin name.

    ``hour_return_pct`` has always carried the plain fraction; ``pct_scale=100`` makes it a percentage.
    """
    coins = dim_coin.select("coin_key", "coin_name", "image_url")
    price = {
        f"price_{name}": F.col(name).cast("decimal(20,8)") for name in ("open", "high", "low", "close", "vwap")
    }
    return prices.join(coins, "coin_key", "left").select(
        F.col("event_hour").alias("ts_hour"),
        "date_key",
        "symbol",
        F.coalesce("coin_name", "symbol").alias("coin_name"),
        "image_url",
        *[expr.alias(name) for name, expr in price.items()],
        _return_pct(pct_scale),
        "ticks_count",
        F.col("avg_spread").cast("decimal(10,6)").alias("avg_spread"),
    )


def _return_pct(pct_scale: int) -> Column:
    return (F.col("hour_return") * pct_scale).cast("decimal(10,4)").alias("hour_return_pct")


def detector_label() -> Column:
    z, forest = F.col("is_anomaly_zscore"), F.col("is_anomaly_iforest")
    return (
        F.when(F.col("is_anomaly_consensus"), "Consensus")
        .when(z & forest, "Both")
        .when(forest, "IForest")
        .when(z, "Z-score")
        .otherwise("Unknown")
    )


def anomaly_view(alerts: DataFrame, dim_coin: DataFrame, pct_scale: int = 1) -> DataFrame:
    """Alerts with coin name, detector label and severity bucket."""
    coins = dim_coin.select("coin_id", "coin_name", "image_url")
    return alerts.join(coins, "coin_id", "left").select(
        F.col("event_hour").alias("ts_hour"),
        "date_key",
        "symbol",
        F.coalesce("coin_name", "coin_id", "symbol").alias("coin_name"),
        "image_url",
        F.col("close").cast("decimal(20,8)").alias("price_close"),
        _return_pct(pct_scale),
        "return_zscore",
        "is_anomaly_zscore",
        "is_anomaly_iforest",
        "is_anomaly_consensus",
        detector_label().alias("detector_label"),
        F.col("severity_score").cast("decimal(10,4)").alias("severity"),
        C.label_at_least(F.col("severity_score"), SEVERITY_STEPS, SEVERITY_FLOOR).alias("severity_bucket"),
        "market_cap_rank",
        "fng_value",
        "fng_bucket",
        "reddit_mentions_day",
        "vader_compound_avg",
        "anomaly_model_version",
        "detected_at",
    )


def sentiment_view(sentiment_daily: DataFrame, scored_posts: DataFrame) -> DataFrame:
    """Index, social activity and scored mood per day."""
    scored = sentiment_share_daily(scored_posts, "decimal(6,4)").withColumnRenamed("posts_scored", "vader_posts_count")
    return sentiment_daily.join(scored, "date_day", "left").select(
        "date_day",
        "fng_value",
        "fng_bucket",
        "fng_score",
        "reddit_posts_count",
        "reddit_avg_upvote_ratio",
        "reddit_total_score",
        "vader_posts_count",
        "vader_compound_avg",
        "vader_pct_positive",
        "vader_pct_negative",
    )


def sentiment_shares_long(view: DataFrame) -> DataFrame:
    """Daily label shares as rows, for a stacked chart; neutral is what the other two leave."""
    shares = view.where(F.col("vader_posts_count").isNotNull()).select(
        "date_day",
        "vader_posts_count",
        F.col("vader_pct_positive").alias("positive"),
        (1 - F.col("vader_pct_positive") - F.col("vader_pct_negative")).cast("decimal(6,4)").alias("neutral"),
        F.col("vader_pct_negative").alias("negative"),
    )
    return shares.unpivot(
        ["date_day", "vader_posts_count"], ["positive", "neutral", "negative"], "sentiment_label", "share"
    )


def market_latest(snapshots: DataFrame, dim_coin: DataFrame) -> DataFrame:
    """Newest snapshot of every coin."""
    newest = latest_by(
        snapshots.select(
            "coin_id", "symbol", "current_price", "market_cap", "market_cap_rank", "volume_24h", "high_24h",
            "low_24h", "price_change_pct_24h", "price_change_pct_7d", "price_change_pct_1h", "snapshot_hour",
        ),
        keys=["coin_id"],
        order=[F.desc("snapshot_hour"), F.asc("symbol")],
    )
    coins = dim_coin.select("coin_id", "coin_name", "image_url")
    return newest.join(coins, "coin_id", "left").select(
        "coin_id",
        "symbol",
        F.coalesce("coin_name", "symbol").alias("coin_name"),
        "image_url",
        F.col("current_price").cast("decimal(24,8)").alias("price"),
        "market_cap",
        "market_cap_rank",
        "volume_24h",
        "high_24h",
        "low_24h",
        F.col("price_change_pct_24h").cast("decimal(12,4)").alias("change_24h_pct"),
        F.col("price_change_pct_7d").cast("decimal(12,4)").alias("change_7d_pct"),
        F.col("price_change_pct_1h").cast("decimal(12,4)").alias("change_1h_pct"),
        F.col("snapshot_hour").alias("as_of"),
    )


# Types a report import pins, per view; columns not named pass through.
IMPORT_TYPES: dict[str, dict[str, str]] = {
    "price_hourly": {
        "ts_hour": "timestamp", "price_open": "double", "price_high": "double", "price_low": "double",
        "price_close": "double", "price_vwap": "double", "hour_return_pct": "double", "ticks_count": "bigint",
    },
    "anomaly_view": {
        "ts_hour": "timestamp", "price_close": "double", "hour_return_pct": "double", "return_zscore": "double",
        "severity": "double", "fng_value": "bigint", "reddit_mentions_day": "bigint",
    },
    "sentiment_view": {
        "date_day": "date", "fng_value": "bigint", "vader_compound_avg": "double", "vader_pct_positive": "double",
        "vader_pct_negative": "double", "reddit_posts_count": "bigint", "vader_posts_count": "bigint",
    },
    "market_latest": {
        "price": "double", "market_cap": "double", "market_cap_rank": "bigint", "volume_24h": "double",
        "change_24h_pct": "double", "change_7d_pct": "double", "change_1h_pct": "double", "as_of": "timestamp",
    },
    "kpi_latest": {},
}


def import_view(
    name: str, view: DataFrame, as_of: C.AsOf = None, price_days: int = PRICE_IMPORT_DAYS
) -> DataFrame:
    """A view as a report tool imports it: types pinned, price history cut to the last days."""
    if name == "price_hourly":
        view = view.where(F.col("ts_hour") >= C.ago(as_of, price_days, "days"))
    return view.withColumns({c: F.col(c).cast(t) for c, t in IMPORT_TYPES[name].items()})


def row_counts(views: dict[str, DataFrame]) -> DataFrame:
    """Rows per view."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("view"), "rows") for n, df in views.items()]
    return reduce(DataFrame.unionByName, counts)


def with_calendar(facts: DataFrame, instant: str, calendar: DataFrame) -> DataFrame:
    """Facts related to the report calendar through the date of ``instant``."""
    return facts.withColumn("date", F.to_date(instant)).join(calendar, "date")
