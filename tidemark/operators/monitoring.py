"""Stream health and live tails."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import columns as C

STALE_MINUTES = 10  # fixed value: the stream counts as dead beyond this lag

# Traffic light by minutes since the last tick.
LIGHT_STEPS = [(5, "🟢"), (15, "🟡")]
LIGHT_LATE, LIGHT_MISSING = "🔴", "⚪"


def ticks_per_symbol(ticks: DataFrame) -> DataFrame:
    return (
        ticks.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("ticks"), F.max("event_time").alias("last_seen"))
        .orderBy(F.desc("ticks"), "symbol")
    )


def symbol_health(ticks: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """Traffic light per symbol."""
    minutes = C.minutes_between(C.as_of_ts(as_of), F.col("last_tick_at"))
    return (
        ticks.groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("ticks_total"), F.max("event_time").alias("last_tick_at"))
        .select(
            C.label_below(minutes, LIGHT_STEPS, LIGHT_LATE, LIGHT_MISSING).alias("status"),
            "symbol",
            "ticks_total",
            "last_tick_at",
            F.round(minutes, 2).alias("minutes_since_last"),
        )
    )


def tick_tail(ticks: DataFrame, n: int = 50) -> DataFrame:
    """The last ``n`` ticks (a top-k report: 20 on the console, 10 to 500 on the live page)."""
    return (
        ticks.select("symbol", "event_time", "price", "volume_base", "bid", "ask")
        .orderBy(F.desc("event_time"), "symbol")
        .limit(n)
    )


def tick_freshness(ticks: DataFrame, as_of: C.AsOf = None, stale_minutes: float = STALE_MINUTES) -> DataFrame:
    """One row: last tick, lag in minutes and a verdict (``empty`` / ``stale`` / ``ok``)."""
    lag = C.minutes_between(C.as_of_ts(as_of), F.col("last_tick"))
    verdict = F.when(F.col("last_tick").isNull(), "empty").when(lag > stale_minutes, "stale").otherwise("ok")
    return ticks.agg(F.max("event_time").alias("last_tick")).select(
        "last_tick", lag.alias("minutes_since_last"), verdict.alias("status")
    )


class StaleStream(RuntimeError):
    """The tick table is empty or too old."""


def check_freshness(ticks: DataFrame, as_of: C.AsOf = None, stale_minutes: float = STALE_MINUTES) -> float:
    """Lag in minutes; raises :class:`StaleStream` when the table is empty or the lag exceeds the limit."""
    row = tick_freshness(ticks, as_of, stale_minutes).first()
    if row.status == "empty":
        raise StaleStream("no ticks at all")
    if row.status == "stale":
        raise StaleStream(f"last tick is {row.minutes_since_last:.1f} minutes old (limit {stale_minutes})")
    return row.minutes_since_last


def price_context(price_view: DataFrame, symbol: str, hours_back: int = 48, as_of: C.AsOf = None) -> DataFrame:
    """Recent closes of one symbol, oldest first."""
    recent = (F.col("symbol") == symbol) & (F.col("ts_hour") >= C.ago(as_of, hours_back, "hours"))
    return price_view.where(recent).select("symbol", "ts_hour", "price_close").orderBy("ts_hour")
