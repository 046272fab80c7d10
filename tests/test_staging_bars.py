"""Hand-computed edges of staging, bars, dimensions and marts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import bars, dims, facts, marts, staging

TICK = "symbol STRING, event_time TIMESTAMP, price DECIMAL(20,8), price_change_pct DECIMAL(10,4), volume_base DECIMAL(24,8), volume_quote DECIMAL(24,8), trades_count BIGINT, bid DECIMAL(20,8), ask DECIMAL(20,8), ingested_at TIMESTAMP"


def at(hour, minute=0, day=1, second=0):
    return datetime(2024, 1, day, hour, minute, second)


def tick(symbol, when, price, volume=1, quote=1, trades=1, bid=1, ask=2):
    from decimal import Decimal

    def d(x):
        return None if x is None else Decimal(str(x))

    return (symbol, when, d(price), None, d(volume), d(quote), trades, d(bid), d(ask), when)


def stage(spark, rows):
    return staging.stg_ticks(spark.createDataFrame(rows, TICK))


def test_tick_filters_and_split(spark):
    rows = [
        tick("BTCUSDT", at(0), 10, bid=0, ask=5),
        tick("EURGBP", at(0), 10),
        tick("USDT", at(0), 10),
        tick("BTCUSDT", at(0), 0),
        tick("BTCUSDT", at(0), 10, volume=-1),
        tick("BTCUSDT", at(0), 10, volume=None),
        tick(None, at(0), 10),
    ]
    out = {r.symbol: r for r in stage(spark, rows).collect()}
    assert set(out) == {"BTCUSDT", "EURGBP", "USDT"}
    assert (out["BTCUSDT"].base_asset, out["BTCUSDT"].quote_asset) == ("BTC", "USDT")
    assert (out["EURGBP"].base_asset, out["EURGBP"].quote_asset) == ("EURGBP", None)
    assert out["USDT"].base_asset == ""
    assert out["BTCUSDT"].spread == 5 and out["BTCUSDT"].spread_pct is None
    assert out["EURGBP"].spread_pct == 100


def test_bar_ties_take_the_largest_value_per_column(spark):
    rows = [
        tick("AUSDT", at(1), 5, volume=1, quote=9, trades=1),
        tick("AUSDT", at(1), 7, volume=2, quote=1, trades=1),
        tick("AUSDT", at(1, 30), 1, volume=3),
        tick("AUSDT", at(1, 59), 4, volume=10, quote=None, trades=8),
        tick("AUSDT", at(1, 59), 6, volume=0, quote=3, trades=None),
    ]
    bar = bars.hourly_bars(stage(spark, rows), 1).first()
    assert (bar.open, bar.close, bar.low, bar.high, bar.ticks_count) == (7, 6, 1, 7, 5)
    assert (bar.volume_base_24h, bar.volume_quote_24h, bar.trades_count_24h) == (10, 3, 8)
    assert bar.vwap == pytest.approx((5 * 1 + 7 * 2 + 1 * 3 + 4 * 10 + 0) / 16)


def test_thin_hours_zero_volume_and_gaps(spark):
    rows = [tick("AUSDT", at(1, m), 10, volume=0) for m in range(10)]
    rows += [tick("AUSDT", at(3, m), 20, volume=5) for m in range(10)]
    rows += [tick("AUSDT", at(2, m), 99) for m in range(9)]
    out = bars.with_bar_deltas(bars.hourly_bars(stage(spark, rows))).orderBy("event_hour").collect()
    assert [r.event_hour for r in out] == [at(1), at(3)]
    assert out[0].vwap is None and out[0].hour_return is None
    assert out[1].hour_return == 1.0 and out[1].hour_volume_base_delta == 5  # previous existing bar


def test_previous_close_of_zero_gives_no_return(spark):
    df = spark.createDataFrame(
        [("A", at(1), 0.0, 1.0, 1), ("A", at(2), 5.0, 1.0, 1)],
        "symbol STRING, event_hour TIMESTAMP, close DOUBLE, volume_base_24h DOUBLE, trades_count_24h BIGINT",
    )
    assert [r.hour_return for r in bars.with_bar_deltas(df).orderBy("event_hour").collect()] == [None, None]


def test_surrogate_key_replaces_null(spark):
    import hashlib

    row = spark.range(1).select(
        C.surrogate_key(F.lit("bitcoin")).alias("a"), C.surrogate_key(F.lit(None), F.lit("2024010101")).alias("b")
    ).first()
    assert row.a == hashlib.md5(b"bitcoin").hexdigest()
    assert row.b == hashlib.md5(b"_dbt_utils_surrogate_key_null_-2024010101").hexdigest()


def _coins(spark, rows):
    return spark.createDataFrame(rows, "coin_key STRING, coin_id STRING, symbol STRING")


def test_bars_join_unmapped_and_shared_symbols(spark):
    ticks = stage(spark, [tick("AUSDT", at(1), 5), tick("BUSDT", at(1), 5), tick("CUSDT", at(1), 5)])
    coins = _coins(spark, [("k1", "a", "a"), ("k2", "b1", "B"), ("k3", "b2", "b")])
    out = facts.fact_prices_hourly(ticks, coins, 1, "2024-01-02").orderBy("symbol", "coin_id").collect()
    assert [(r.symbol, r.coin_id) for r in out] == [("A", "a"), ("B", "b1"), ("B", "b2"), ("C", None)]
    assert out[3].price_hour_key is not None and out[3].date_key == 20240101


def test_calendar_edges(spark):
    days = {r.date_day: r for r in dims.dim_date(spark, "2024-06-15 10:00:00").collect()}
    assert len(days) == 2192
    first = days[date(2023, 1, 1)]
    assert (first.iso_week, first.day_of_week, first.is_weekend, first.month_name) == (52, 0, True, "January  ")
    assert days[date(2024, 6, 15)].is_today and days[date(2024, 6, 14)].is_yesterday
    assert days[date(2024, 6, 8)].is_last_7_days and not days[date(2024, 6, 7)].is_last_7_days
    assert days[date(2028, 12, 31)].is_last_30_days  # no upper bound
    report = [r.date for r in dims.report_calendar(spark, "2025-01-05").orderBy("date").collect()]
    assert (report[0], report[-1]) == (date(2025, 1, 1), date(2025, 2, 3))
    assert dims.report_calendar(spark, "2024-01-05").count() == 0


def test_index_buckets_and_latest_reading(spark):
    rows = [
        (at(0), 24, "Extreme Fear", at(1)),
        (at(5), 25, "Fear", at(9)),
        (at(0, day=2), 54, "Neutral", at(1, day=2)),
        (at(0, day=3), 75, "X", at(1, day=3)),
    ]
    df = spark.createDataFrame(rows, "index_date TIMESTAMP, value INT, category STRING, ingested_at TIMESTAMP")
    out = [(r.value, r.sentiment_bucket, r.sentiment_score) for r in staging.stg_index(df).orderBy("index_date").collect()]
    assert out == [(25, "fear", -0.5), (54, "neutral", 0.08), (75, "extreme_greed", 0.5)]


def _posts(spark, rows):
    full = [
        (i, "Bitcoin", title, text, "a", 1, 0.5, 1, at(1), "u", True, nsfw, "/p", at(1)) for i, title, text, nsfw in rows
    ]
    return spark.createDataFrame(
        full,
        "id STRING, subreddit STRING, title STRING, selftext STRING, author STRING, score INT, upvote_ratio DOUBLE, "
        "num_comments INT, created_utc TIMESTAMP, url STRING, is_self BOOLEAN, over_18 BOOLEAN, permalink STRING, "
        "ingested_at TIMESTAMP",
    )


def test_post_filters_and_whole_word_mentions(spark):
    posts = _posts(
        spark,
        [
            ("1", "btc up", None, False),
            ("2", "xBTC éBTC BTCé BTC_", "sol", False),
            ("3", None, "BTC", False),
            ("4", "BTC", "", True),
            ("5", "BTC", "", None),
            ("6", "(Ethereum)", "z" * 600 + " doge", False),
        ],
    )
    out = {r.id: r for r in staging.stg_posts(posts).collect()}
    assert set(out) == {"1", "2", "6"}
    assert out["1"].mentions_btc and not out["1"].mentions_eth
    assert not out["2"].mentions_btc and out["2"].mentions_sol
    assert out["6"].mentions_eth and out["6"].mentions_doge  # far beyond the preview
    assert len(out["6"].selftext_preview) == 500 and out["1"].subreddit == "bitcoin"


def test_sentiment_keeps_days_with_one_source(spark):
    index = staging.stg_index(
        spark.createDataFrame(
            [(at(0, day=1), 10, "x", at(0))], "index_date TIMESTAMP, value INT, category STRING, ingested_at TIMESTAMP"
        )
    )
    posts = staging.stg_posts(_posts(spark, [("1", "btc", "", False)]).withColumn("created_utc", F.lit(at(3, day=2))))
    out = facts.fact_sentiment_daily(index, posts).orderBy("date_key").collect()
    assert [(r.date_key, r.fng_value, r.reddit_posts_count, r.mentions_btc) for r in out] == [
        (20240101, 10, 0, 0),
        (20240102, None, 1, 1),
    ]


def _snapshots(spark, rows):
    return spark.createDataFrame(
        rows,
        "date_key INT, coin_key STRING, coin_id STRING, symbol STRING, market_cap DOUBLE, market_cap_rank INT, "
        "current_price DOUBLE, price_change_pct_24h DOUBLE, volume_24h DOUBLE, snapshot_hour TIMESTAMP",
    )


def test_movers_filter_rank_before_and_change_after_choosing_the_last(spark):
    rows = [
        (1, "a", "a", "A", 1.0, 5, 1.0, 3.0, 1.0, at(1)),
        (1, "a", "a", "A", 1.0, 201, 1.0, 9.0, 1.0, at(2)),  # later, but out of rank: the first one counts
        (1, "b", "b", "B", 1.0, 5, 1.0, 4.0, 1.0, at(1)),
        (1, "b", "b", "B", 1.0, 5, 1.0, None, 1.0, at(2)),  # the last has no change: the coin drops out
        (1, "c", "c", "C", 1.0, 5, 1.0, 3.0, 1.0, at(1)),
        (1, "d", "d", "D", 1.0, None, 1.0, 3.0, 1.0, at(1)),
        (1, "e", "e", "E", 1.0, 200, 1.0, -1.0, 1.0, at(1)),
    ]
    out = {r.coin_id: (r.rank_gainer, r.rank_loser) for r in marts.top_movers_daily(_snapshots(spark, rows)).collect()}
    assert out == {"a": (1, 2), "c": (1, 2), "e": (3, 1)}
