"""Dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import columns as C
from tidemark.operators.latest import latest_by

# Span of the warehouse calendar and start of the reporting calendar.
CALENDAR_START, CALENDAR_END = date(2023, 1, 1), date(2028, 12, 31)
REPORT_CALENDAR_START = date(2025, 1, 1)
NAME_WIDTH = 9  # month and day names are blank-padded to the longest English name


def dim_coin(stg_markets: DataFrame, as_of: C.AsOf = None) -> DataFrame:
    """One row per coin, taken from its newest snapshot."""
    columns = ["coin_id", "symbol", "coin_name", "image_url", "max_supply", "circulating_supply", "total_supply"]
    newest = latest_by(
        stg_markets.select(*columns, "ingested_at"),
        keys=["coin_id"],
        order=[F.desc("ingested_at"), F.asc("symbol"), F.asc("coin_name")],
    )
    return newest.select(
        C.surrogate_key("coin_id").alias("coin_key"), *columns, C.as_of_ts(as_of).alias("dw_updated_at")
    )


def _days(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    days = F.when(first <= last, F.sequence(first, last))  # no days, not a descending list, when empty
    return spark.range(1).select(F.explode(days).alias("day"))


def dim_date(
    spark: SparkSession,
    as_of: C.AsOf = None,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    trim_names: bool = False,
) -> DataFrame:
    """Calendar dimension. The last-7/30-days flags have no upper bound: future days count too."""
    today = C.as_of_date(as_of)
    day = F.col("day")
    weekday = F.dayofweek(day) - 1  # Sunday = 0

    def name(pattern: str) -> Column:
        text = F.date_format(day, pattern)
        return text if trim_names else F.rpad(text, NAME_WIDTH, " ")

    return _days(spark, F.lit(start), F.lit(end)).select(
        C.date_key(day).alias("date_key"),
        day.alias("date_day"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        name("MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        name("EEEE").alias("day_name"),
        F.weekofyear(day).alias("iso_week"),
        weekday.isin(0, 6).alias("is_weekend"),
        (day == today).alias("is_today"),
        (day == F.date_sub(today, 1)).alias("is_yesterday"),
        (day >= F.date_sub(today, 7)).alias("is_last_7_days"),
        (day >= F.date_sub(today, 30)).alias("is_last_30_days"),
    )


def report_calendar(spark: SparkSession, as_of: C.AsOf = None, start: date = REPORT_CALENDAR_START) -> DataFrame:
    """Rolling calendar for reports: ``start`` up to, not including, today + 30 days."""
    last = F.date_add(C.as_of_date(as_of), 29)
    day = F.col("day")
    return _days(spark, F.lit(start), last).select(
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("weekday"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )
