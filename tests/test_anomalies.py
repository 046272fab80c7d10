"""Z-score edges and properties of the isolation forest."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import anomalies as A, forest

START = datetime(2024, 1, 1)
SCHEMA = "symbol STRING, event_hour TIMESTAMP, close DOUBLE, hour_return DOUBLE, volume_base DOUBLE, avg_spread DOUBLE, ticks_count BIGINT"


def series(spark, values, symbol="A", volume=1.0):
    rows = [(symbol, START + timedelta(hours=i), 1.0 + i, v, volume, 0.1, 10) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def z_of(spark, values):
    out = series(spark, values).withColumn("z", A.rolling_zscore("hour_return")).orderBy("event_hour")
    return [r.z for r in out.collect()]


def test_zscore_equals_rolling_mean_and_deviation(spark):
    values = [math.sin(i * 1.7) + i % 5 for i in range(60)]
    s = pd.Series(values)
    expected = (s - s.rolling(24).mean()) / s.rolling(24).std()
    got = z_of(spark, values)
    assert got[:23] == [None] * 23
    assert np.allclose(np.array(got[23:], dtype=float), expected[23:])


def test_zscore_undefined_inside_gaps_and_constants(spark):
    assert z_of(spark, [0.5] * 30) == [None] * 30
    got = z_of(spark, [None] + [float(i % 7) for i in range(30)])
    assert got[23] is None and got[24] is not None
    assert z_of(spark, [float("nan")] + [float(i % 7) for i in range(23)])[23] is None


def test_flag_uses_the_unrounded_score(spark):
    out = A.flag_zscore(series(spark, [float(i % 3) for i in range(23)] + [100.0]), threshold=4.0).orderBy("event_hour")
    last = out.collect()[-1]
    assert last.is_anomaly_zscore and last.return_zscore == round(last.return_zscore, 4)
    assert not out.first().is_anomaly_zscore


def test_imputation_median_then_zero(spark):
    df = series(spark, [None, 1.0, 3.0, 100.0]).withColumn("avg_spread", F.lit(None).cast("double"))
    out = A.impute_features(df).orderBy("event_hour").collect()
    assert out[0].x_hour_return == 3.0 and out[0].x_avg_spread == 0.0 and out[0].points == 4


@pytest.fixture(scope="module")
def detected(spark):
    rng = np.random.default_rng(7)
    rows = []
    for symbol, n in (("HOT", 1500), ("MID", 300), ("FEW", 47), ("EDGE", 48)):
        for i in range(n):
            planted = symbol == "MID" and i in (100, 200)
            rows.append(
                (symbol, START + timedelta(hours=i), float(i + 1), 5.0 if planted else float(rng.normal(0, 0.01)),
                 900.0 if planted else float(rng.normal(10, 1)), 3.0 if planted else float(rng.normal(0.1, 0.01)), 10)
            )
    df = spark.createDataFrame(rows, SCHEMA)
    return df, A.detect_anomalies(df, as_of="2024-06-01").toPandas()


def test_forest_keeps_every_row_and_the_gate(detected):
    df, out = detected
    assert len(out) == df.count() and not out.duplicated(["symbol", "event_hour"]).any()
    few = out[out.symbol == "FEW"]
    assert few.iforest_score.isna().all() and not few.is_anomaly_iforest.any()
    assert out[out.symbol == "EDGE"].iforest_score.notna().all()


def test_forest_flags_about_the_contamination(detected):
    _, out = detected
    for symbol in ("HOT", "MID"):
        assert out[out.symbol == symbol].is_anomaly_iforest.mean() == pytest.approx(0.05, abs=0.01)


def test_planted_outliers_rank_first(detected):
    _, out = detected
    mid = out[out.symbol == "MID"].sort_values("iforest_score")
    hours = {START + timedelta(hours=h) for h in (100, 200)}
    assert set(mid.event_hour.iloc[:2].dt.to_pydatetime()) == hours
    assert mid.is_anomaly_consensus.iloc[:2].all()


def test_forest_does_not_depend_on_partitioning(spark, detected):
    df, out = detected
    again = A.detect_anomalies(df.repartition(7, F.rand(3)), as_of="2024-06-01").toPandas()
    key = ["symbol", "event_hour"]
    a, b = out.sort_values(key).reset_index(drop=True), again.sort_values(key).reset_index(drop=True)
    assert np.allclose(a.iforest_score.astype(float), b.iforest_score.astype(float), equal_nan=True)


def test_pools_are_bounded_and_chunks_split_a_hot_group(spark, detected, monkeypatch):
    df, _ = detected
    monkeypatch.setattr(forest, "CHUNK_ROWS", 100)  # many chunks per symbol: same verdicts
    split = A.detect_anomalies(df, as_of="2024-06-01").toPandas()
    whole = detected[1]
    merged = split.merge(whole, on=["symbol", "event_hour"])
    assert (merged.is_anomaly_iforest_x == merged.is_anomaly_iforest_y).all()
    monkeypatch.setattr(forest, "POOL_ROWS", 200)
    ready = A.impute_features(df)
    pools = {r.symbol: r.pool for r in forest.pools(ready, "symbol", ["event_hour"], ["x_hour_return"], "points", 42).collect()}
    assert len(pools["HOT"]) == 200 and len(pools["FEW"]) == 47
    values = {r.x_hour_return for r in ready.where("symbol = 'HOT'").collect()}
    assert len({p[0] for p in pools["HOT"]} & values) == 200


def test_rows_are_shuffled_once_for_all_trees(spark, detected):
    """What enters the sampling exchange is the history, not the history times the trees."""
    ready = A.impute_features(detected[0])
    drawn = forest.pools(ready, "symbol", ["event_hour"], ["x_hour_return"], "points", 42)
    text = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text and "Window" in text
    trees = forest.fit(ready, "symbol", ["event_hour"], ["x_hour_return"], "points", 60, 42)
    assert {(r.symbol, r.tree) for r in trees.collect()} == {(s, t) for s in ("HOT", "MID", "FEW", "EDGE") for t in range(60)}
    assert {r.sampled for r in trees.where("symbol IN ('HOT', 'MID')").collect()} == {256}


def test_stored_forest_scores_by_walking_its_nodes(spark):
    df = series(spark, [float(i) for i in range(50)])
    nodes = [  # one cut at 9.5: ten points on a path of 1, forty on a path of 3
        ("A", 0, 8, 0, 0, 9.5, 1, 2, 0.0), ("A", 0, 8, 1, 0, 0.0, 1, 1, 1.0), ("A", 0, 8, 2, 0, 0.0, 2, 2, 3.0),
    ]
    table = spark.createDataFrame(nodes, "symbol STRING, tree INT, sampled INT, node INT, feature INT, threshold DOUBLE, low INT, high INT, path DOUBLE")
    out = A.detect_anomalies(df, as_of="2024-06-01", contamination=0.5, stored_forest=forest.from_nodes(table, "symbol")).orderBy("event_hour").collect()
    norm = float(forest.mean_path(8))
    assert [r.iforest_score for r in out[:10]] == [round(2 ** (-3 / norm) - 2 ** (-1 / norm), 6)] * 10
    assert [r.is_anomaly_iforest for r in out] == [True] * 10 + [False] * 40


def test_mean_path_matches_known_values():
    assert forest.mean_path(1) == 0 and forest.mean_path(2) == 1
    assert float(forest.mean_path(256)) == pytest.approx(10.2448, abs=1e-3)
