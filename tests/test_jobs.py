"""The hourly and daily compositions end to end, alerts and reporting on small tables."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import alerts, quality
from tidemark.plans import jobs, measures, reporting, suites
from tidemark.plans.catalog import AS_OF, Frames
from tidemark.sources import fixtures as fx
from tidemark.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def world(spark, sf_dir, tmp_path_factory):
    """A warehouse filled with the landing fixtures of the next larger test scale."""
    frames = Frames(spark, sf_dir.replace("sf0.001", "sf0.01"))
    w = Warehouse(spark, str(tmp_path_factory.mktemp("world")))
    w.write_batch("ticks", frames.ticks)
    w.write_batch("markets", frames.markets)
    w.write_batch("posts", frames.posts)
    w.write_batch("index", frames.index)
    return w


SETTINGS = jobs.Settings(
    min_ticks=fx.MIN_TICKS, terms=fx.TERMS, min_severity=2.0, alert_lookback_hours=720, anomaly_lookback_hours=720
)


def deliver(df):
    return df.withColumn("response_ok", F.length("message") > 0)


def test_hourly_then_daily(spark, world, tmp_path):
    checks = suites.business_suites(pairs=[f"{s}USDT" for s in fx.TERMS], bases=list(fx.TERMS))
    settings = jobs.Settings(**{**SETTINGS.__dict__, "quality_results": str(tmp_path / "dq")})

    def broken():
        raise OSError("feed down")

    outcome = jobs.run_hourly(world, deliver, {"posts": broken, "index": lambda: "ok"}, AS_OF, settings, checks)
    assert outcome == {"posts": "FAILED: feed down", "index": "ok"}
    sent = world.count("ledger")
    assert sent > 0
    detections = world.count("anomalies")
    jobs.run_hourly(world, deliver, {}, AS_OF, SETTINGS, checks)  # same instant again: nothing new
    assert world.count("ledger") == sent and world.count("anomalies") == detections
    report = spark.read.json(str(tmp_path / "dq"))
    assert report.where("critical and not success").count() == 0 and report.count() == 29

    limits = {"ticks": quality.Freshness("event_time", 60, 24 * 60)}
    results = jobs.run_daily(world, fx.lexicon(spark), AS_OF, SETTINGS, limits)
    assert results.where("not success").count() == 0
    scored = world.count("sentiment")
    assert 0 < scored < world.count("posts")  # the last two days only
    jobs.run_sentiment(world, fx.lexicon(spark), 30, as_of=AS_OF)
    assert world.count("sentiment") == world.read("posts").where(F.col("created_utc") >= "2024-01-01").count()

    views = jobs.reporting_views(world, AS_OF)
    counts = {r.view: r.rows for r in reporting.row_counts(views).collect()}
    assert counts["kpi_latest"] == 1 and counts["price_hourly"] == world.count("fact_prices_hourly")


def test_shared_symbols_alert_once_and_keys_are_checked_before_delivery(spark, world, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    mart = world.read("mart_anomaly_alerts")
    w.write_mart("mart_anomaly_alerts", mart.unionByName(mart))  # as two coins on each symbol give it
    w.write_mart("dim_coin", world.read("dim_coin"))
    sent = jobs.notify(w, deliver, AS_OF, SETTINGS)
    assert sent.count() == sent.select("alert_key").distinct().count() == w.count("ledger") > 0
    assert jobs.notify(w, deliver, AS_OF, SETTINGS).count() == 0

    nameless = Warehouse(spark, str(tmp_path / "n"))
    nameless.write_mart("mart_anomaly_alerts", mart.withColumn("symbol", F.lit(None).cast("string")))
    nameless.write_mart("dim_coin", world.read("dim_coin"))
    handed = []
    with pytest.raises(ValueError, match="alert_key"):
        jobs.notify(nameless, lambda df: handed.append(df) or deliver(df), AS_OF, SETTINGS)
    assert not handed


def test_critical_failure_stops_before_alerts(world):
    with pytest.raises(quality.QualityFailure, match="raw_ticks"):
        jobs.run_hourly(world, deliver, {}, AS_OF, SETTINGS)  # production domains reject the fixture's symbols


def test_stale_sources_stop_the_daily_run(world, spark):
    with pytest.raises(jobs.monitoring.StaleStream, match="ticks"):
        jobs.run_daily(world, fx.lexicon(spark), "2024-03-01", SETTINGS)


def test_incremental_bars_equal_a_full_refresh(spark, sf_dir):
    f = Frames(spark, sf_dir.replace("sf0.001", "sf0.01"))
    full = f.prices.drop("dw_updated_at")
    partial = jobs.refresh_bars(f.prices, f.stg_ticks, f.dim_coin, "2024-01-20 07:30:00", fx.MIN_TICKS, AS_OF)
    partial = partial.drop("dw_updated_at").select(full.columns)
    drop = ["vwap", "avg_spread"]  # sums of doubles: compared rounded
    rounded = [F.round(c, 6).alias(c) for c in drop]
    a = full.select(*[c for c in full.columns if c not in drop], *rounded)
    b = partial.select(*[c for c in full.columns if c not in drop], *rounded)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_load_steps_write_bronze_and_landing(spark, world, tmp_path):
    from tidemark.sources import bronze, landed

    payload = spark.createDataFrame(
        [([("58", "Greed", "1713657600", "1")],)], "data ARRAY<STRUCT<value: STRING, value_classification: STRING, timestamp: STRING, time_until_update: STRING>>"
    )
    w = Warehouse(spark, str(tmp_path / "w"))
    steps = jobs.load_steps(w, str(tmp_path / "bronze"), {"index": landed.index_rows(payload, AS_OF)}, AS_OF)
    assert jobs.run_batch(steps)["index"].endswith("fng/index")
    jobs.run_batch(steps)
    assert w.count("index") == 1
    assert bronze.read_bronze(spark, str(tmp_path / "bronze"), "fng", "index").count() == 1


VIEW = """ts_hour TIMESTAMP, symbol STRING, coin_name STRING, price_close DECIMAL(20,8), hour_return_pct DECIMAL(10,4),
return_zscore DOUBLE, severity DECIMAL(10,4), severity_bucket STRING, detector_label STRING, fng_value INT,
fng_bucket STRING, reddit_mentions_day BIGINT, vader_compound_avg DECIMAL(8,4), is_anomaly_consensus BOOLEAN"""


def alert(hour, severity, symbol="BTC", consensus=True, ret="-0.0123"):
    d = Decimal
    return (datetime(2024, 1, 1, hour), symbol, "Bitcoin", d("51250.5"), d(ret), -4.21, d(severity), "High", "Consensus",
            65, "greed", 7, d("0.1234"), consensus)


def test_alert_selection_and_ledger(spark):
    view = spark.createDataFrame(
        [alert(5, "3.0"), alert(6, "9.0"), alert(6, "4.0", "ETH"), alert(7, "2.9"), alert(1, "9.0"), alert(7, "5", consensus=False)],
        VIEW,
    )
    empty = spark.createDataFrame([], schemas.ledger())
    pending = alerts.pending_alerts(view, empty, as_of="2024-01-01 08:00:00")
    keys = [r.alert_key for r in pending.collect()]
    assert keys == ["BTC|202401010600", "ETH|202401010600", "BTC|202401010500"]
    ledger = alerts.ledger_rows(pending.withColumn("response_ok", F.col("symbol") == "ETH"), "2024-01-01 08:00:00")
    assert alerts.pending_alerts(view, ledger, as_of="2024-01-01 08:00:00").count() == 0
    again = alerts.pending_alerts(view, ledger, as_of="2024-01-01 08:00:00", retry_failed=True)
    assert [r.symbol for r in again.collect()] == ["BTC", "BTC"]


def test_alert_text(spark):
    rows = [alert(6, "4.21"), alert(7, "5", "ETH", ret="0.5")]
    df = spark.createDataFrame(rows, VIEW).withColumn("event_hour", F.col("ts_hour")).orderBy("symbol")
    stored = [r.m for r in df.select(alerts.alert_text().alias("m")).collect()]
    assert stored[0] == (
        "<b>📉 Anomaly · BTC</b>\n<i>Bitcoin</i> · <b>High</b> (sev 4.2100)\n\n"
        "• Hora: <code>2024-01-01 06:00:00+00:00</code>\n• Precio close: <code>51250.50000000</code>\n"
        "• Retorno hora: <code>-0.0123 %</code>\n• Z-score: <code>-4.2100</code>\n• Detector: <code>Consensus</code>\n"
        "• Fear &amp; Greed: <code>65 (greed)</code>\n• Reddit mentions: <code>7</code>\n• VADER avg: <code>0.1234</code>\n"
    )
    assert stored[1].startswith("<b>📈 Anomaly · ETH")
    rounded = df.select(alerts.alert_text(rounded=True).alias("m")).first().m
    assert "<code>51250.5000</code>" in rounded and "(sev 4.21)" in rounded and "-0.012 %" in rounded
    blank = df.withColumns({c: F.lit(None).cast("double") for c in ("price_close", "severity", "hour_return_pct")})
    text = blank.select(alerts.alert_text().alias("m")).first().m
    assert "(sev n/a)" in text and "Precio close: <code>n/a" in text and "📈" in text


def test_kpi_row_survives_empty_tables(spark, world):
    w = Warehouse(spark, world.root + "-empty")
    mart = spark.createDataFrame([], "event_hour TIMESTAMP, is_anomaly_consensus BOOLEAN, severity_score DOUBLE")
    daily = spark.createDataFrame([], "fng_value INT, fng_bucket STRING, date_day DATE")
    snaps = spark.createDataFrame([], "coin_id STRING, market_cap DOUBLE, snapshot_hour TIMESTAMP")
    kpi = reporting.kpi_latest(w.read("ticks"), mart, daily, w.read("sentiment"), snaps, AS_OF)
    row = kpi.first()
    assert (row.symbols_with_ticks_24h, row.last_tick_at, row.fng_value, row.anomaly_events_24h) == (0, None, None, 0)
    cards = measures.kpi_measures(kpi).first()
    assert (cards.stream_health_label, cards.stream_health_color) == ("NO DATA", "#6B7280")
    assert (cards.max_severity_label, cards.fear_greed_label, cards.total_market_cap_formatted) == ("LOW", "Unknown", "$0")


def test_price_measures_keep_null_slices(spark):
    rows = [(None, "2024-01-01 00:00:00", 10.0, 1.0, 10.0, 3), (None, "2024-01-01 01:00:00", 12.0, 2.0, 11.0, 4), ("a", "2024-01-01 00:00:00", 5.0, 0.5, 5.0, 2)]
    df = spark.createDataFrame(
        [(c, datetime.fromisoformat(t), p, m, v, n) for c, t, p, m, v, n in rows],
        "coin_name STRING, ts_hour TIMESTAMP, price_close DOUBLE, hour_return_pct DOUBLE, price_vwap DOUBLE, ticks_count BIGINT",
    )
    got = {r.coin_name: r for r in measures.price_measures(df, ["coin_name"]).collect()}
    assert set(got) == {None, "a"} and got[None].price_close_latest == 12.0 and got[None].last_return_pct == 2.0
    assert got[None].total_ticks == 7 and got["a"].price_close_latest == 5.0


def test_price_measures_by_hand(spark):
    df = spark.createDataFrame(
        [("A", datetime(2024, 1, 1, 1), 10.0, 10.0, 10.0, 1), ("B", datetime(2024, 1, 1, 1), 12.0, None, 20.0, 3),
         ("A", datetime(2024, 1, 1, 2), 11.0, 10.0, 30.0, 0), ("A", datetime(2024, 1, 1, 3), None, None, None, 2)],
        "symbol STRING, ts_hour TIMESTAMP, price_close DOUBLE, hour_return_pct DOUBLE, price_vwap DOUBLE, ticks_count BIGINT",
    )
    r = measures.price_measures(df).first()
    assert (r.price_close_latest, r.last_return_pct, r.total_ticks) == (11.0, 10.0, 6)
    assert r.cumulative_return_pct == pytest.approx(21.0)
    assert r.volatility_return_pct == 0 and r.avg_vwap == pytest.approx(70 / 6)


def test_best_performer_ties_and_money(spark):
    df = spark.createDataFrame(
        [("b", 1.0, 5.0), ("a", 3.0, 5.0), ("z", 1.0, -1.0), ("n", 5.0, None)],
        "coin_name STRING, market_cap DOUBLE, change_24h_pct DOUBLE",
    )
    r = measures.market_measures(df).first()
    assert (r.best_performer_24h, r.worst_performer_24h, r.coins_up_24h, r.coins_down_24h) == ("a", "z", 2, 1)
    shown = spark.createDataFrame([(2.12e12,), (3.5e9,), (1e6,), (999.0,)], "v DOUBLE")
    assert [x[0] for x in shown.select(measures._money(F.col("v"))).collect()] == ["$2.12T", "$3.50B", "$1.00M", "$999"]
