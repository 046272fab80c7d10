"""The declared checks: business suites, model tests, source tests and freshness limits."""

from __future__ import annotations

from tidemark.operators.bars import MIN_TICKS_PER_HOUR
from tidemark.operators.quality import (
    Freshness,
    Suite,
    accepted_values,
    between,
    columns_present,
    expression,
    not_accepted_values,
    not_null,
    pair_at_least,
    relationship,
    unique,
)

# Accepted domains.
TRACKED_PAIRS = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "ADAUSDT", "XRPUSDT", "DOGEUSDT", "AVAXUSDT", "DOTUSDT"]
TRACKED_BASES = ["BTC", "ETH", "SOL", "ADA", "XRP", "DOGE", "AVAX", "DOT"]
SENTIMENT_LABELS = ["positive", "neutral", "negative"]
INDEX_BUCKETS = ["extreme_fear", "fear", "neutral", "greed", "extreme_greed"]
FORUMS = ["cryptocurrency", "bitcoin", "ethereum", "solana"]
MENTION_SYMBOLS = ["BTC", "ETH", "SOL", "ADA", "XRP", "DOGE"]


def business_suites(pairs=TRACKED_PAIRS, bases=TRACKED_BASES) -> dict[str, Suite]:
    return {
        "raw_ticks": Suite(
            "ticks",
            (
                columns_present(
                    "symbol", "event_time", "price", "price_change_pct", "volume_base", "volume_quote",
                    "trades_count", "bid", "ask", "ingested_at",
                ),
                *not_null("symbol", "event_time", "price"),
                between("price", 0, strict_low=True),
                between("volume_base", 0),
                accepted_values("symbol", pairs),
            ),
            critical=True,
        ),
        "fact_prices_hourly": Suite(
            "fact_prices_hourly",
            (
                unique("symbol", "event_hour"),
                *not_null("open", "close"),
                between("open", 0, strict_low=True),
                between("close", 0, strict_low=True),
                pair_at_least("high", "low"),
                between("ticks_count", 1),
                accepted_values("symbol", bases),
            ),
            critical=True,
        ),
        "mart_anomaly_alerts": Suite(
            "mart_anomaly_alerts",
            (
                between("severity_score", 0),
                *not_null(
                    "is_anomaly_zscore", "is_anomaly_iforest", "is_anomaly_consensus", "anomaly_model_version",
                    "detected_at",
                ),
                accepted_values("symbol", bases),
            ),
        ),
        "reddit_sentiment": Suite(
            "sentiment",
            (
                between("compound", -1.0, 1.0),
                between("pos", 0.0, 1.0),
                between("neu", 0.0, 1.0),
                between("neg", 0.0, 1.0),
                accepted_values("sentiment_label", SENTIMENT_LABELS),
                *not_null("post_id", "model_version"),
            ),
        ),
    }


def source_suites() -> dict[str, Suite]:
    return {
        "source.ticks": Suite("ticks", (*not_null("symbol", "event_time", "price"),)),
        "source.markets": Suite("markets", (*not_null("id", "symbol", "ingested_at"),)),
        "source.index": Suite("index", (*not_null("index_date", "value"), unique("index_date"))),
        "source.posts": Suite("posts", (*not_null("id", "subreddit", "created_utc"), unique("id"))),
        "source.sentiment": Suite(
            "sentiment",
            (
                *not_null("post_id", "compound", "sentiment_label"),
                unique("post_id"),
                accepted_values("sentiment_label", SENTIMENT_LABELS),
            ),
        ),
        "source.anomalies": Suite("anomalies", (*not_null("symbol", "event_hour", "is_anomaly_consensus"),)),
    }


def staging_suites(forums=FORUMS) -> dict[str, Suite]:
    return {
        "stg_ticks": Suite(
            "stg_ticks",
            (
                *not_null("symbol", "base_asset", "event_time", "price"),
                not_accepted_values("symbol", ["", " "]),
                expression("price", "> 0"),
                expression("spread", ">= 0"),
            ),
        ),
        "stg_markets": Suite(
            "stg_markets",
            (
                *not_null("coin_id", "symbol", "current_price"),
                expression("current_price", "> 0"),
                between("market_cap_rank", 1, 1000),
            ),
        ),
        "stg_index": Suite(
            "stg_index",
            (
                *not_null("index_date", "value"),
                unique("index_date"),
                between("value", 0, 100),
                accepted_values("sentiment_bucket", INDEX_BUCKETS),
                between("sentiment_score", -1, 1),
            ),
        ),
        "stg_posts": Suite(
            "stg_posts",
            (
                *not_null("id", "subreddit", "created_utc", "score"),
                unique("id"),
                accepted_values("subreddit", forums),
                between("upvote_ratio", 0, 1),
            ),
        ),
        "stg_sentiment": Suite(
            "stg_sentiment",
            (
                *not_null("post_id", "compound", "sentiment_label", "sentiment_score"),
                unique("post_id"),
                between("compound", -1, 1),
                between("pos", 0, 1),
                between("neu", 0, 1),
                between("neg", 0, 1),
                accepted_values("sentiment_label", SENTIMENT_LABELS),
                accepted_values("sentiment_score", [-1, 0, 1]),
            ),
        ),
        "stg_anomalies": Suite(
            "stg_anomalies",
            (
                *not_null(
                    "symbol", "event_hour", "is_anomaly_zscore", "is_anomaly_iforest", "is_anomaly_consensus",
                    "zscore_threshold",
                ),
                expression("zscore_threshold", "> 0"),
                unique("symbol", "event_hour"),
            ),
        ),
    }


def mart_suites(min_ticks: int = MIN_TICKS_PER_HOUR, mention_symbols=MENTION_SYMBOLS) -> dict[str, Suite]:
    to_date = relationship("date_key", "dim_date", "date_key")
    to_coin = relationship("coin_key", "dim_coin", "coin_key")
    return {
        "dim_coin": Suite(
            "dim_coin",
            (*not_null("coin_key", "coin_id", "symbol", "coin_name"), unique("coin_key"), unique("coin_id")),
        ),
        "dim_date": Suite(
            "dim_date",
            (*not_null("date_key", "date_day"), unique("date_key"), unique("date_day"), between("day_of_week", 0, 6)),
        ),
        "fact_prices": Suite(
            "fact_prices_hourly",
            (
                *not_null("price_hour_key", "coin_key", "date_key", "event_hour", "open", "close"),
                unique("price_hour_key"),
                to_coin,
                to_date,
                expression("open", "> 0"),
                expression("close", "> 0"),
                expression("high", ">= low"),
                expression("low", "> 0"),
                expression("ticks_count", f">= {min_ticks}"),
                unique("coin_key", "event_hour"),
            ),
        ),
        "fact_market_snapshot": Suite(
            "fact_market_snapshot",
            (
                *not_null("market_snapshot_key", "coin_key", "date_key", "current_price"),
                unique("market_snapshot_key"),
                to_coin,
                to_date,
                expression("current_price", "> 0"),
                between("market_cap_rank", 1, 2000),
                unique("coin_key", "snapshot_hour"),
            ),
        ),
        "fact_sentiment_daily": Suite(
            "fact_sentiment_daily",
            (
                *not_null("date_key", "reddit_posts_count"),
                unique("date_key"),
                to_date,
                between("fng_value", 0, 100),
                expression("reddit_posts_count", ">= 0"),
            ),
        ),
        "mart_top_movers_daily": Suite(
            "mart_top_movers_daily",
            (
                *not_null("date_key", "coin_key", "rank_gainer", "rank_loser"),
                to_coin,
                unique("date_key", "coin_key"),
            ),
        ),
        "mart_social_vs_price": Suite(
            "mart_social_vs_price",
            (
                *not_null("date_key", "symbol", "mentions_count"),
                accepted_values("symbol", mention_symbols),
                expression("mentions_count", ">= 0"),
                unique("date_key", "symbol"),
            ),
        ),
        "mart_alerts": Suite(
            "mart_anomaly_alerts",
            (
                *not_null("symbol", "event_hour", "date_key", "is_anomaly_consensus", "severity_score"),
                to_date,
                expression("severity_score", ">= 0"),
                unique("symbol", "event_hour"),
            ),
        ),
    }


# Age limits of the sources, in minutes.
FRESHNESS = {
    "ticks": Freshness("event_time", 5, 30),
    "markets": Freshness("ingested_at", 2 * 60, 24 * 60),
    "index": Freshness("ingested_at", 26 * 60, 48 * 60),
    "posts": Freshness("ingested_at", 2 * 60, 24 * 60),
    "sentiment": Freshness("scored_at", 6 * 60, 48 * 60),
    "anomalies": Freshness("detected_at", 6 * 60, 48 * 60),
}
