"""Physical plans that decide whether an operator holds at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.bars import hourly_bars
from tidemark.operators.latest import latest_by
from tidemark.plans import catalog, measures


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def frames(spark, sf_dir):
    return catalog.Frames(spark, sf_dir)


def test_bars_combine_before_the_exchange(frames):
    text = plan(hourly_bars(frames.stg_ticks))
    assert text.count("Exchange") == 1
    assert text.index("partial_min") > text.index("Exchange")  # plans print top-down
    assert "Window" not in text
    assert "SortAggregate" not in text and "HashAggregate" in text
    assert not re.search(r"\bSort\b", text)


def test_latest_row_is_limited_before_the_exchange(frames):
    text = plan(latest_by(frames.markets, ["id"], [F.desc("ingested_at")]))
    assert re.search(r"WindowGroupLimit.*Partial", text)
    assert text.count("Exchange") == 1


def test_mentions_are_unpivoted_in_one_scan(frames):
    assert plan(marts.mentions_long(frames.daily, {"CLICK": (), "VIEW": ()})).count("documents.parquet") == 1


def test_zscore_medians_and_counts_share_one_exchange(frames):
    from tidemark.operators import anomalies

    stored = frames.bars.select("symbol", "event_hour", "close", "hour_return", "hour_volume_base_delta", "avg_spread", "ticks_count")
    base = plan(anomalies.price_history(stored, as_of=catalog.AS_OF)).count("Exchange")
    full = anomalies.impute_features(anomalies.flag_zscore(anomalies.price_history(stored, as_of=catalog.AS_OF)))
    assert plan(full).count("Exchange") == base


def test_tick_filter_reaches_the_scan(spark, frames, tmp_path):
    from tidemark.operators.staging import stg_ticks

    frames.ticks.write.parquet(str(tmp_path / "ticks"))
    df = hourly_bars(stg_ticks(spark.read.parquet(str(tmp_path / "ticks"))))
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThan(price" in pushed and "GreaterThanOrEqual(volume_base" in pushed
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "ingested_at" not in schema and "price_change_pct" not in schema


def test_market_share_has_no_global_window(spark):
    market = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "coin_name STRING, market_cap DOUBLE")
    shares = measures.market_share(market)
    assert "Window" not in plan(shares)
    assert [(r.coin_name, r.share) for r in shares.collect()] == [("b", 0.75), ("a", 0.25)]


def _formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _partition_filters(df):
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", _formatted(df))


def test_look_backs_prune_days(spark, frames, tmp_path):
    """KPI, scoring and detection open the days of their look-back only."""
    from tidemark.functions import columns as C
    from tidemark.operators import anomalies, sentiment
    from tidemark.plans import reporting
    from tidemark.sources.warehouse import Warehouse

    w = Warehouse(spark, str(tmp_path))
    w.write_batch("ticks", frames.ticks)
    w.write_batch("posts", frames.posts)
    w.write_mart("fact_prices_hourly", frames.prices)
    day_ago = C.ago(catalog.AS_OF, 24, "hours")
    kpi = reporting.kpi_latest(w.read("ticks", day_ago), frames.alerts, frames.daily, frames.scored, frames.snapshots, catalog.AS_OF)
    assert any("dt" in f and ">=" in f for f in _partition_filters(kpi))
    posts = sentiment.posts_to_score(w.read("posts", C.ago(catalog.AS_OF, 3, "days")), None, 3, catalog.AS_OF)
    history = anomalies.price_history(w.read("fact_prices_hourly", C.ago(catalog.AS_OF, 48, "hours")), 48, catalog.AS_OF)
    for df in (posts, history):
        (pruned,) = _partition_filters(df)
        assert "dt" in pruned and ">=" in pruned
    bounded = w.read("ticks", "2024-01-03 00:00:00", "2024-01-05 00:00:00")
    assert {r.d.day for r in bounded.selectExpr("to_date(event_time) AS d").distinct().collect()} <= {3, 4}
    assert len(bounded.inputFiles()) >= len({f.split("dt=")[1][:10] for f in bounded.inputFiles()}) > 2  # files() ignores filters
    scanned = {r.f.split("dt=")[1][:10] for r in bounded.selectExpr("input_file_name() AS f").distinct().collect()}
    assert scanned <= {"2024-01-03", "2024-01-04"}


def test_a_backfill_writes_one_file_a_day(spark, frames, tmp_path):
    from tidemark.sources import bronze
    from tidemark.sources.warehouse import Warehouse

    w = Warehouse(spark, str(tmp_path / "w"))
    w.write_batch("ticks", frames.ticks.repartition(7))
    files = list((tmp_path / "w" / "ticks").glob("dt=*/*.parquet"))
    days = {f.parent.name for f in files}
    assert len(days) >= 29 and len(files) == len(days)
    bronze.write_bronze(frames.index.repartition(5), str(tmp_path / "b"), "s", "d", F.col("index_date"))
    files = list((tmp_path / "b").rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files}) > 29
