"""Report measures over the reporting views.

Every function aggregates the frame it is given, so a caller's filter is the report filter;
``by`` adds slices. All are ordinary aggregates with map-side combining.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import columns as C
from tidemark.plans.reporting import one_row

By = Sequence[str]

# Stream health labels (minutes since the last tick) and their colours.
HEALTH_STEPS = [(5, "HEALTHY"), (15, "DEGRADED")]
HEALTH_LATE, HEALTH_MISSING = "STALE", "NO DATA"
HEALTH_COLORS = {"HEALTHY": "#16A34A", "DEGRADED": "#F59E0B", "STALE": "#DC2626"}
HEALTH_OTHER_COLOR = "#6B7280"

# Severity labels of the KPI card and units of the market-cap card.
CARD_SEVERITY_STEPS = [(5, "CRITICAL"), (3, "HIGH"), (1, "MEDIUM")]
CARD_SEVERITY_FLOOR = "LOW"
CAP_UNITS = [(1e12, "T"), (1e9, "B"), (1e6, "M")]
REFRESH_PREFIX = "Ultima actualizacion: "


def _merge(parts: Sequence[DataFrame], by: By) -> DataFrame:
    """Aggregates at the same grain next to each other."""
    if not by:
        return one_row(parts)
    merged = parts[0]
    for part in parts[1:]:
        # A slice may be NULL.
        names = {c: f"_{c}" for c in by}
        same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
        merged = merged.join(part.withColumnsRenamed(names), same, "left").drop(*names.values())
    return merged


def kpi_measures(kpi: DataFrame) -> DataFrame:
    """The card measures of the KPI row, blanks replaced by their defaults."""
    minutes = F.col("minutes_since_last_tick")
    health = C.label_below(minutes, HEALTH_STEPS, HEALTH_LATE, HEALTH_MISSING)

    def zero_if_blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    severity = zero_if_blank("max_severity_24h").cast("double")
    cap = zero_if_blank("total_market_cap_tracked").cast("double")
    return kpi.select(
        minutes.alias("minutes_since_last_tick"),
        health.alias("stream_health_label"),
        C.pick(health, {k: F.lit(v) for k, v in HEALTH_COLORS.items()}, F.lit(HEALTH_OTHER_COLOR)).alias(
            "stream_health_color"
        ),
        zero_if_blank("symbols_with_ticks_24h").alias("symbols_active_24h"),
        zero_if_blank("anomaly_events_24h").alias("anomalies_24h"),
        zero_if_blank("anomaly_events_consensus_24h").alias("anomalies_consensus_24h"),
        severity.alias("max_severity_24h"),
        C.label_at_least(severity, CARD_SEVERITY_STEPS, CARD_SEVERITY_FLOOR).alias("max_severity_label"),
        F.col("fng_value").alias("fear_greed_latest"),
        F.coalesce("fng_bucket", F.lit("Unknown")).alias("fear_greed_label"),
        zero_if_blank("vader_compound_avg_24h").cast("double").alias("vader_compound_24h"),
        zero_if_blank("reddit_posts_scored_24h").alias("reddit_posts_24h"),
        cap.alias("total_market_cap"),
        _money(cap).alias("total_market_cap_formatted"),
        "refreshed_at",
        F.concat(F.lit(REFRESH_PREFIX), F.date_format("refreshed_at", "yyyy-MM-dd HH:mm")).alias(
            "refreshed_at_label"
        ),
    )


def _money(value: Column) -> Column:
    out = F
    for unit, suffix in CAP_UNITS:
        text = F.concat(F.lit("$"), F.format_string("%.2f", value / unit), F.lit(suffix))
        out = out.when(value >= unit, text)
    return out.otherwise(F.concat(F.lit("$"), F.format_number(value, 0)))


def price_measures(prices: DataFrame, by: By = ()) -> DataFrame:
    """Latest close and return, volatility, compound return, tick-weighted VWAP and ticks."""
    typed = prices.select(
        *by,
        "ts_hour",
        *[F.col(c).cast("double").alias(c) for c in ("price_close", "hour_return_pct", "price_vwap")],
        "ticks_count",
    )
    # Hours first: a report slice may hold several coins, of which each hour keeps the largest value.
    hours = typed.groupBy(*by, "ts_hour").agg(
        F.max("price_close").alias("price"), F.max("hour_return_pct").alias("move")
    )

    def last_known(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("ts_hour")))

    hourly = hours.groupBy(*by).agg(
        last_known("price").alias("price_close_latest"),
        last_known("move").alias("last_return_pct"),
        ((F.product(1 + F.coalesce("move", F.lit(0.0)) / 100) - 1) * 100).alias("cumulative_return_pct"),
    )
    ticks = F.col("ticks_count")
    rows = typed.groupBy(*by).agg(
        F.stddev_pop("hour_return_pct").alias("volatility_return_pct"),
        C.safe_div(F.sum(F.col("price_vwap") * ticks), F.sum(ticks)).alias("avg_vwap"),
        F.sum(ticks).alias("total_ticks"),
    )
    return _merge([rows, hourly], by)


def price_normalized(prices: DataFrame, by: str = "coin_name") -> DataFrame:
    """Close per hour relative to the slice's lowest close, base 100. One window row per hour of a coin."""
    close = F.col("price_close").cast("double")
    hours = prices.groupBy(by, "ts_hour").agg(F.max(close).alias("high"), F.min(close).alias("low"))
    base = F.min("low").over(Window.partitionBy(by))
    return hours.select(by, "ts_hour", (C.safe_div(F.col("high"), base) * 100).alias("price_normalized"))


def alert_measures(alerts: DataFrame, by: By = ()) -> DataFrame:
    """Alert counts by detector, mean severity and critical alerts."""
    detector, severity = F.col("detector_label"), F.col("severity").cast("double")
    return alerts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("alerts_count"),
        F.count_if(detector == "Consensus").alias("alerts_consensus"),
        F.count_if(detector == "Z-score").alias("alerts_zscore_only"),
        F.count_if(detector == "IForest").alias("alerts_iforest_only"),
        F.avg(severity).alias("avg_severity"),
        F.count_if(severity >= 5).alias("critical_alerts"),
    )


def sentiment_measures(sentiment: DataFrame, by: By = ()) -> DataFrame:
    """Mean mood, posts, label shares in percent and mean index."""

    def mean(name: str) -> Column:
        return F.avg(F.col(name).cast("double"))

    return sentiment.groupBy(*by).agg(
        mean("vader_compound_avg").alias("avg_vader_compound"),
        F.sum("reddit_posts_count").alias("total_reddit_posts"),
        (mean("vader_pct_positive") * 100).alias("pct_positive_posts"),
        (mean("vader_pct_negative") * 100).alias("pct_negative_posts"),
        mean("fng_value").alias("avg_fear_greed"),
    )


def market_measures(market: DataFrame, by: By = ()) -> DataFrame:
    """Market cap, cap-weighted change, risers and fallers, best and worst performer."""
    cap, change = F.col("market_cap").cast("double"), F.col("change_24h_pct").cast("double")
    totals = market.groupBy(*by).agg(
        F.sum(cap).alias("marketcap_filtered"),
        C.safe_div(F.sum(cap * change), F.sum(cap)).alias("weighted_change_24h"),
        F.count_if(change > 0).alias("coins_up_24h"),
        F.count_if(change < 0).alias("coins_down_24h"),
        # Largest (smallest) change; a tie goes to the first name in sort order.
        F.min(F.when(change.isNotNull(), F.struct((-change).alias("c"), "coin_name")))["coin_name"].alias(
            "best_performer_24h"
        ),
        F.min(F.when(change.isNotNull(), F.struct(change.alias("c"), "coin_name")))["coin_name"].alias(
            "worst_performer_24h"
        ),
    )
    return totals


def market_share(market: DataFrame) -> DataFrame:
    """Coins by market cap with their share of the total. The total is a scalar subquery, not a window."""
    total = market.agg(F.sum(F.col("market_cap").cast("double"))).scalar()
    cap = F.col("market_cap").cast("double")
    return market.select("coin_name", cap.alias("market_cap"), C.safe_div(cap, total).alias("share")).orderBy(
        F.desc("market_cap"), "coin_name"
    )


def top_changes(market: DataFrame, top: int = 10) -> DataFrame:
    """Report table of the strongest risers (a top-k report)."""
    return (
        market.select("coin_name", "price", "change_24h_pct", "change_7d_pct")
        .orderBy(F.desc_nulls_last("change_24h_pct"), "coin_name")
        .limit(top)
    )
