"""Scheduled compositions: batch load, marts, models, checks, alerts. The order is fixed; scheduling is not done here."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import schemas
from tidemark.functions import columns as C
from tidemark.functions.terms import ASSET_TERMS
from tidemark.operators import alerts, anomalies, dims, facts, marts, monitoring, quality, sentiment, staging
from tidemark.operators.bars import MIN_TICKS_PER_HOUR, hourly_bars, with_bar_deltas
from tidemark.plans import reporting, suites
from tidemark.session import settle
from tidemark.sources import bronze, landed
from tidemark.sources.warehouse import Warehouse, check_batch_keys
from tidemark.streaming import compaction

HOURLY_LOOKBACK_HOURS = 168  # fixed value: anomaly window of the hourly run
DAILY_LOOKBACK_DAYS = 2  # fixed value: scoring window of the daily run


@dataclass
class Settings:
    """What the jobs can be told; the defaults are the production values."""

    min_ticks: int = MIN_TICKS_PER_HOUR
    terms: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(ASSET_TERMS))
    min_severity: float = alerts.MIN_SEVERITY
    alert_lookback_hours: int = alerts.LOOKBACK_HOURS
    anomaly_lookback_hours: int = HOURLY_LOOKBACK_HOURS
    sentiment_lookback_days: int = sentiment.LOOKBACK_DAYS
    quality_results: str | None = None


def run_batch(steps: Mapping[str, Callable[[], str]]) -> dict[str, str]:
    """Run every load; one that fails is recorded and the others go on."""
    outcome: dict[str, str] = {}
    for name, step in steps.items():
        try:
            outcome[name] = step()
        except Exception as error:  # noqa: BLE001 - the point is to isolate any failure
            outcome[name] = f"FAILED: {error}"
    return outcome


def load_steps(
    warehouse: Warehouse, bronze_root: str, landing: Mapping[str, DataFrame], as_of: C.AsOf = None
) -> dict[str, Callable[[], str]]:
    """Load steps for parsed feeds (rows with lineage columns): bronze copy, then the landing table."""
    names = {"markets": ("coingecko", "market_data"), "index": ("fng", "index"), "posts": ("reddit", "posts")}

    def step(kind: str) -> Callable[[], str]:
        def load() -> str:
            # One parse of the landed JSON feeds both writes.
            rows = settle(landing[kind], kind)
            written = bronze.write_bronze(rows, bronze_root, *names[kind], partition_ts=C.as_of_ts(as_of))
            warehouse.write_batch(kind, landed.to_landing(rows, getattr(schemas, kind)()))
            return written

        return load

    return {kind: step(kind) for kind in landing}


def refresh_marts(
    warehouse: Warehouse, as_of: C.AsOf = None, settings: Settings | None = None, stream_root: str | None = None
) -> None:
    """Refresh of all marts but the alert mart, which needs the detections first.

    Each table is written once and read back by those that build on it. With ``stream_root``, the consumer's folder,
    bars are recomputed for the hours its new batches touched; otherwise from all ticks.
    """
    settings = settings or Settings()
    spark = warehouse.spark
    stg_markets = staging.stg_markets(warehouse.read("markets"))
    coins = warehouse.write_mart("dim_coin", dims.dim_coin(stg_markets, as_of))
    warehouse.write_mart("dim_date", dims.dim_date(spark, as_of))
    if stream_root:
        refresh_stream_bars(warehouse, stream_root, coins, settings.min_ticks, as_of)
    else:
        ticks = staging.stg_ticks(warehouse.read("ticks"))
        warehouse.write_mart("fact_prices_hourly", facts.fact_prices_hourly(ticks, coins, settings.min_ticks, as_of))
    snapshots = warehouse.write_mart("fact_market_snapshot", facts.fact_market_snapshot(stg_markets, coins, as_of))
    daily = warehouse.write_mart(
        "fact_sentiment_daily",
        facts.fact_sentiment_daily(
            staging.stg_index(warehouse.read("index")),
            staging.stg_posts(warehouse.read("posts"), settings.terms),
            settings.terms,
            as_of,
        ),
    )
    warehouse.write_mart("mart_top_movers_daily", marts.top_movers_daily(snapshots, as_of=as_of))
    warehouse.write_mart("mart_social_vs_price", marts.social_vs_price(daily, snapshots, settings.terms, as_of))


def refresh_bars(
    stored: DataFrame,
    stg_ticks: DataFrame,
    dim_coin: DataFrame,
    since: C.AsOf,
    min_ticks: int = MIN_TICKS_PER_HOUR,
    as_of: C.AsOf = None,
) -> DataFrame:
    """The hourly fact after recomputing only the hours from ``since`` on.

    The tick scan is limited to those hours; each symbol's last stored bar before them
    restores the deltas of its first new one. ``stg_ticks`` may be all ticks: the filter
    reaches the scan. Equal to a full refresh as long as earlier hours got no late ticks.
    """
    cut = F.date_trunc("hour", C.as_of_ts(since))
    kept = stored.where(F.col("event_hour") < cut)
    bar_columns = [
        "symbol", "event_hour", "open", "high", "low", "close", "vwap", "avg_spread", "ticks_count",
        "volume_base_24h", "volume_quote_24h", "trades_count_24h",
    ]
    before = (
        kept.groupBy("symbol")
        .agg(F.max_by(F.struct(*[c for c in bar_columns if c != "symbol"]), "event_hour").alias("bar"))
        .select("symbol", "bar.*")
    )
    fresh = hourly_bars(stg_ticks.where(F.col("event_time") >= cut), min_ticks).select(*bar_columns)
    deltas = with_bar_deltas(before.select(*bar_columns).unionByName(fresh)).where(F.col("event_hour") >= cut)
    return kept.unionByName(facts.key_bars(deltas, dim_coin, as_of))


BAR_COLUMNS = [
    "symbol", "event_hour", "open", "high", "low", "close", "vwap", "avg_spread", "ticks_count",
    "volume_base_24h", "volume_quote_24h", "trades_count_24h",
]
PREVIOUS_BAR_DAYS = 7  # days in which a symbol's previous bar is looked for first


def refresh_stream_bars(
    warehouse: Warehouse,
    stream_root: str,
    coins: DataFrame,
    min_ticks: int = MIN_TICKS_PER_HOUR,
    as_of: C.AsOf = None,
) -> list[date]:
    """Move closed days into the warehouse and bring the hourly fact up to date with the batches that came since
    the last run; returns the days rewritten. Batches are marked last, so an interrupted run is repeated whole."""
    touched = settle(compaction.touched_hours(warehouse.spark, stream_root), "touched")
    compaction.compact(warehouse, stream_root, as_of)
    hours = touched.select("event_hour").distinct()
    first, last = hours.agg(F.min("event_hour"), F.max("event_hour") + F.expr("INTERVAL 1 HOUR")).first()
    if first is None:
        return []
    ticks = compaction.all_ticks(warehouse, stream_root, first, last)
    days = refresh_touched_bars(warehouse, ticks, hours, first, coins, min_ticks, as_of)
    compaction.mark_refreshed(touched, stream_root)
    return days


def refresh_touched_bars(
    warehouse: Warehouse,
    ticks: DataFrame,
    hours: DataFrame,
    first: datetime,
    coins: DataFrame,
    min_ticks: int = MIN_TICKS_PER_HOUR,
    as_of: C.AsOf = None,
) -> list[date]:
    """Recompute the bars of ``hours`` (``event_hour``, the earliest being ``first``) from all ticks of these hours, and
    the deltas of the bars after them. Only the days that hold such bars are rewritten; the result equals a full
    refresh, in whatever order ticks came."""
    name, hour = "fact_prices_hourly", F.date_trunc("hour", "event_time")
    fresh = staging.stg_ticks(ticks).withColumn("_hour", hour)
    fresh = fresh.join(hours.select(F.col("event_hour").alias("_hour")), "_hour", "left_semi").drop("_hour")
    fresh = settle(hourly_bars(fresh, min_ticks).select(*BAR_COLUMNS).withColumn("_fresh", F.lit(True)), "fresh-bars")
    if warehouse.exists(name):
        since = F.lit(first) - F.make_interval(days=F.lit(PREVIOUS_BAR_DAYS))
        known = warehouse.read(name, since).dropDuplicates(["symbol", "event_hour"]).select(*BAR_COLUMNS)
        before = known.where(F.col("event_hour") < F.lit(first)).select("symbol")
        # a symbol that was silent for longer: its last bar, wherever it is
        silent = fresh.select("symbol").distinct().join(before, "symbol", "left_anti")
        if not silent.isEmpty():
            older = warehouse.read(name, until=since).join(silent, "symbol", "left_semi")
            older = older.groupBy("symbol").agg(F.max_by(F.struct(*BAR_COLUMNS[1:]), "event_hour").alias("bar"))
            known = known.unionByName(older.select("symbol", "bar.*"))
        known = known.join(hours, "event_hour", "left_anti").withColumn("_fresh", F.lit(False))
        series = known.select(*BAR_COLUMNS, "_fresh").unionByName(fresh)
    else:
        series = fresh
    follows = F.lag("_fresh", 1, False).over(Window.partitionBy("symbol").orderBy("event_hour"))
    series = settle(with_bar_deltas(series).withColumn("_changed", F.col("_fresh") | follows), "bar-series")
    # Calendar days of the touched hours and of the bars after them.
    days = [r[0] for r in series.where("_changed").select(F.to_date("event_hour")).distinct().collect()]
    rows = facts.key_bars(series.where(F.to_date("event_hour").isin(days)).drop("_fresh", "_changed"), coins, as_of)
    if days and warehouse.exists(name):
        # of bars that did not change, the deltas are the stored ones: their predecessor may lie before the series
        rows = settle(rows, "bar-rows")
        changed = series.where("_changed").select("symbol", "event_hour")
        stored = warehouse.read(name, F.lit(min(days)).cast("timestamp")).where(F.to_date("event_hour").isin(days))
        stored = stored.join(changed, ["symbol", "event_hour"], "left_anti").join(hours, "event_hour", "left_anti")
        rows = rows.join(changed, ["symbol", "event_hour"], "left_semi").unionByName(stored)
    if days:
        warehouse.write_days(name, rows.select(*facts.PRICE_FACT_COLUMNS))
    return sorted(days)


def run_sentiment(
    warehouse: Warehouse,
    lexicon: DataFrame,
    lookback_days: int = sentiment.LOOKBACK_DAYS,
    rescore_all: bool = False,
    as_of: C.AsOf = None,
) -> None:
    """Score recent posts that have no score yet (or all of them) and upsert the scores."""
    scored = None if rescore_all else warehouse.read("sentiment")
    recent = warehouse.read("posts", C.ago(as_of, lookback_days, "days"))
    posts = sentiment.posts_to_score(recent, scored, lookback_days, as_of)
    scores = sentiment.score_posts(posts, lexicon).withColumn("scored_at", C.as_of_ts(as_of))
    warehouse.write_batch("sentiment", scores)


def run_anomalies(
    warehouse: Warehouse, lookback_hours: int = anomalies.LOOKBACK_HOURS, as_of: C.AsOf = None, **options
) -> None:
    """Detect over the recent bars and upsert the detections."""
    recent = warehouse.read("fact_prices_hourly", C.ago(as_of, lookback_hours, "hours"))
    history = anomalies.price_history(recent, lookback_hours, as_of)
    warehouse.write_batch("anomalies", anomalies.detect_anomalies(history, as_of=as_of, **options))


def run_models(
    warehouse: Warehouse,
    lexicon: DataFrame,
    as_of: C.AsOf = None,
    skip_sentiment: bool = False,
    skip_anomalies: bool = False,
    settings: Settings | None = None,
) -> None:
    settings = settings or Settings()
    if not skip_sentiment:
        run_sentiment(warehouse, lexicon, settings.sentiment_lookback_days, as_of=as_of)
    if not skip_anomalies:
        run_anomalies(warehouse, anomalies.LOOKBACK_HOURS, as_of)


def refresh_alerts(warehouse: Warehouse, as_of: C.AsOf = None, settings: Settings | None = None) -> None:
    settings = settings or Settings()
    mart = marts.anomaly_alerts(
        staging.stg_anomalies(warehouse.read("anomalies")),
        warehouse.read("fact_prices_hourly"),
        warehouse.read("fact_market_snapshot"),
        warehouse.read("fact_sentiment_daily"),
        warehouse.read("sentiment"),
        settings.terms,
        as_of,
    )
    warehouse.write_mart("mart_anomaly_alerts", mart)


def reporting_views(warehouse: Warehouse, as_of: C.AsOf = None) -> dict[str, DataFrame]:
    """The five reporting views over the stored tables."""
    coins, prices = warehouse.read("dim_coin"), warehouse.read("fact_prices_hourly")
    snapshots, daily = warehouse.read("fact_market_snapshot"), warehouse.read("fact_sentiment_daily")
    mart, scored = warehouse.read("mart_anomaly_alerts"), warehouse.read("sentiment")
    return {
        "kpi_latest": reporting.kpi_latest(warehouse.read("ticks", C.ago(as_of, 24, "hours")), mart, daily, scored, snapshots, as_of),
        "price_hourly": reporting.price_hourly(prices, coins),
        "anomaly_view": reporting.anomaly_view(mart, coins),
        "sentiment_view": reporting.sentiment_view(daily, scored),
        "market_latest": reporting.market_latest(snapshots, coins),
    }


def check_tables(warehouse: Warehouse) -> dict[str, DataFrame | None]:
    """Every table the suites name, staged views included; marts not built yet are None."""
    w = warehouse
    names = [
        "dim_coin", "dim_date", "fact_prices_hourly", "fact_market_snapshot", "fact_sentiment_daily",
        "mart_top_movers_daily", "mart_social_vs_price", "mart_anomaly_alerts",
    ]
    tables: dict[str, DataFrame | None] = {n: w.read(n) if w.exists(n) else None for n in names}
    tables |= {n: w.read(n) for n in ("ticks", "markets", "index", "posts", "sentiment", "anomalies")}
    tables |= {
        "stg_ticks": staging.stg_ticks(w.read("ticks")),
        "stg_markets": staging.stg_markets(w.read("markets")),
        "stg_index": staging.stg_index(w.read("index")),
        "stg_posts": staging.stg_posts(w.read("posts")),
        "stg_sentiment": staging.stg_sentiment(w.read("sentiment")),
        "stg_anomalies": staging.stg_anomalies(w.read("anomalies")),
    }
    return tables


def notify(
    warehouse: Warehouse,
    deliver: Callable[[DataFrame], DataFrame],
    as_of: C.AsOf = None,
    settings: Settings | None = None,
) -> DataFrame:
    """Select new alerts, hand their texts to ``deliver`` and enter them in the ledger.

    ``deliver`` gets the alerts with a ``message`` column and returns them with ``response_ok``.
    The selection is settled first, so what is entered is exactly what was handed over, and its keys are
    checked before anything goes out: what was sent can always be entered.
    """
    settings = settings or Settings()
    view = reporting.anomaly_view(warehouse.read("mart_anomaly_alerts"), warehouse.read("dim_coin"))
    pending = alerts.pending_alerts(
        view, warehouse.read("ledger"), settings.min_severity, settings.alert_lookback_hours, as_of
    )
    selected = settle(alerts.one_per_key(pending).withColumn("message", alerts.alert_text()), "pending-alerts")
    check_batch_keys(selected, warehouse.specs["ledger"].key)
    delivered = settle(deliver(selected), "delivered-alerts")
    warehouse.write_batch("ledger", alerts.ledger_rows(delivered, as_of))
    return delivered


def run_hourly(
    warehouse: Warehouse,
    deliver: Callable[[DataFrame], DataFrame],
    loads: Mapping[str, Callable[[], str]] | None = None,
    as_of: C.AsOf = None,
    settings: Settings | None = None,
    checks: Mapping[str, quality.Suite] | None = None,
    stream_root: str | None = None,
) -> dict[str, str]:
    """Load, marts, detections, alert mart, checks, alerts. A failed critical suite stops before alerts go out."""
    settings = settings or Settings()
    outcome = run_batch(loads or {})
    refresh_marts(warehouse, as_of, settings, stream_root)
    run_anomalies(warehouse, settings.anomaly_lookback_hours, as_of)
    refresh_alerts(warehouse, as_of, settings)
    run_id = f"hourly-{warehouse.spark.range(1).select(F.date_format(C.as_of_ts(as_of), 'yyyyMMddHHmmss')).first()[0]}"
    suites_to_run = suites.business_suites() if checks is None else checks
    quality.checkpoint(warehouse.spark, suites_to_run, check_tables(warehouse), run_id, settings.quality_results)
    notify(warehouse, deliver, as_of, settings)
    return outcome


def run_daily(
    warehouse: Warehouse,
    lexicon: DataFrame,
    as_of: C.AsOf = None,
    settings: Settings | None = None,
    limits: Mapping[str, quality.Freshness] = suites.FRESHNESS,
) -> DataFrame:
    """Source freshness, scoring of the last days, what depends on it, its checks. Returns the check results."""
    sources = {n: warehouse.read(n) for n in limits}
    stale = quality.freshness(sources, limits, as_of).where("status = 'error'").collect()
    if stale:
        raise monitoring.StaleStream(f"sources too old: {', '.join(sorted(r.source for r in stale))}")
    run_sentiment(warehouse, lexicon, DAILY_LOOKBACK_DAYS, as_of=as_of)
    refresh_alerts(warehouse, as_of, settings)
    wanted = {
        **{n: s for n, s in suites.staging_suites().items() if n == "stg_sentiment"},
        **{n: s for n, s in suites.mart_suites().items() if n == "mart_alerts"},
    }
    return quality.run_suites(warehouse.spark, wanted, check_tables(warehouse))

