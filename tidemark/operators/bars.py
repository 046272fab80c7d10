"""Hourly OHLCV bars from ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import columns as C

MIN_TICKS_PER_HOUR = 10  # fixed value: thinner hours are dropped


def hourly_bars(ticks: DataFrame, min_ticks: int = MIN_TICKS_PER_HOUR) -> DataFrame:
    """One bar per (symbol, hour) from staged ticks.

    Open / close take the largest value among the ticks at the first / last instant of
    the hour, each column on its own: ``max_by`` over one number made of instant and value. Its
    buffers have a fixed width, so the aggregation hashes and sorts nothing, and is combined on
    the map side: a hot symbol or hour ships one row per map task, where a window over
    (symbol, hour) would ship every tick.
    """
    price, volume = F.col("price"), F.col("volume_base")
    return (
        ticks.groupBy(F.col("base_asset").alias("symbol"), "event_hour")
        .agg(
            F.min("price").alias("low"),
            F.max("price").alias("high"),
            F.count(F.lit(1)).alias("ticks_count"),
            C.safe_div(F.sum(price * volume), F.sum(volume)).alias("vwap"),
            F.avg("spread").alias("avg_spread"),
            _at_first("price").alias("open"),
            _at_last("price").alias("close"),
            _at_last("volume_base").alias("volume_base_24h"),
            _at_last("volume_quote").alias("volume_quote_24h"),
            _at_last("trades_count").alias("trades_count_24h"),
        )
        .where(F.col("ticks_count") >= min_ticks)
    )


def _order(micros: Column, name: str) -> Column:
    """Orders by ``micros`` (up to an hour), then by value at the landing scale of 8 digits; NULL is lowest."""
    # greatest and least pass over NULL, so NULL is told apart first
    value = F.expr(f"CASE WHEN {name} IS NOT NULL THEN try_cast(greatest(least({name}, 9e15D), -9e15D) AS decimal(24,8)) END")
    above_null = F.coalesce(value + F.lit(10**16).cast("decimal(17,0)"), F.lit(0).cast("decimal(25,8)"))
    return micros.cast("decimal(10,0)") * F.lit(10**17).cast("decimal(18,0)") + above_null


def _micros() -> Column:
    return F.unix_micros("event_time") - F.unix_micros("event_hour")


def _at_last(name: str) -> Column:
    return F.max_by(name, _order(_micros(), name))


def _at_first(name: str) -> Column:
    return F.max_by(name, _order(F.lit(3_600_000_000) - _micros(), name))


def with_bar_deltas(bars: DataFrame) -> DataFrame:
    """Volume / trade deltas and return against the symbol's previous existing bar.

    The window holds one row per hour of one symbol, so its size is bounded by the
    calendar (8,784 rows a year), however many ticks the symbol has.
    """
    series = Window.partitionBy("symbol").orderBy("event_hour")

    def previous(name: str) -> Column:
        return F.lag(name).over(series)

    return bars.withColumns(
        {
            "hour_volume_base_delta": F.col("volume_base_24h") - previous("volume_base_24h"),
            "hour_trades_delta": F.col("trades_count_24h") - previous("trades_count_24h"),
            "hour_return": C.safe_div(F.col("close"), previous("close")) - 1,
        }
    )
