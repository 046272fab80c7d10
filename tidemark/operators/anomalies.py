"""Hourly price anomalies: rolling z-score, isolation forest and their consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import columns as C
from tidemark.operators import forest

# Detector settings and the tag stored with every detection.
ZSCORE_WINDOW = 24
ZSCORE_THRESHOLD = 3.0
CONTAMINATION = 0.05
MIN_POINTS = 48
LOOKBACK_HOURS = 24 * 30
MODEL_VERSION = "iforest-v1+zscore-w24"

FEATURES = ["hour_return", "volume_base", "avg_spread"]


def price_history(prices: DataFrame, lookback_hours: int = LOOKBACK_HOURS, as_of: C.AsOf = None) -> DataFrame:
    """Detector input: recent bars, doubles, the hourly volume delta as the volume feature.

    A symbol that several coins share has one row for each coin and hour; its series is taken once.
    """
    recent = prices.where(F.col("event_hour") >= C.ago(as_of, lookback_hours, "hours"))
    return recent.dropDuplicates(["symbol", "event_hour"]).select(
        "symbol",
        "event_hour",
        C.number("close").alias("close"),
        C.number("hour_return").alias("hour_return"),
        C.number("hour_volume_base_delta").alias("volume_base"),
        C.number("avg_spread").alias("avg_spread"),
        "ticks_count",
    )


def rolling_zscore(value: Column | str, window: int = ZSCORE_WINDOW) -> Column:
    """z of the current row within the last ``window`` rows of its symbol, itself included.

    NULL until the window is full, when any value inside is NULL, or when they are all equal.
    """
    value = C.number(value)
    frame = Window.partitionBy("symbol").orderBy("event_hour", "close").rowsBetween(1 - window, 0)
    centred = value - F.avg(value).over(frame)
    full = F.count(value).over(frame) == window
    return F.when(full, centred / F.nullif(F.stddev_samp(value).over(frame), F.lit(0.0)))


def flag_zscore(history: DataFrame, window: int = ZSCORE_WINDOW, threshold: float = ZSCORE_THRESHOLD) -> DataFrame:
    """Adds the z-score (rounded for storage) and its flag (decided on the unrounded value).

    The window sees one row per hour of a symbol: bounded by the calendar, not by tick volume.
    """
    return history.withColumn("_z", rolling_zscore("hour_return", window)).select(
        *history.columns,
        F.round("_z", 4).alias("return_zscore"),
        F.coalesce(F.abs("_z") >= threshold, F.lit(False)).alias("is_anomaly_zscore"),
        F.lit(float(threshold)).alias("zscore_threshold"),
    )


def impute_features(history: DataFrame) -> DataFrame:
    """NULL feature -> median of the symbol -> 0, plus the number of points of the symbol.

    Medians and counts use the partitioning the z-score window already needed, so they add
    no shuffle; the group is again one row per calendar hour.
    """
    symbol = Window.partitionBy("symbol")
    filled = {f"x_{f}": F.coalesce(F.col(f), F.median(f).over(symbol), F.lit(0.0)) for f in FEATURES}
    return history.withColumns({**filled, "points": F.count(F.lit(1)).over(symbol)})


def detect_anomalies(
    history: DataFrame,
    window: int = ZSCORE_WINDOW,
    threshold: float = ZSCORE_THRESHOLD,
    contamination: float = CONTAMINATION,
    min_points: int = MIN_POINTS,
    trees: int = forest.TREES,
    seed: int = forest.SEED,
    as_of: C.AsOf = None,
    stored_forest: DataFrame | None = None,
) -> DataFrame:
    """Both detectors over the bars of all symbols in one job.

    Symbols below ``min_points`` get no forest score and a false forest flag. ``stored_forest`` (see
    :func:`tidemark.operators.forest.from_nodes`) is scored with instead of growing one from these bars.
    """
    scored = forest.score(
        impute_features(flag_zscore(history, window, threshold)),
        group="symbol",
        row_key=["event_hour", "close"],
        features=[f"x_{f}" for f in FEATURES],
        size="points",
        contamination=contamination,
        min_size=min_points,
        trees=trees,
        seed=seed,
        forest=stored_forest,
    )
    return scored.select(
        "symbol",
        "event_hour",
        "close",
        "hour_return",
        "volume_base",
        "return_zscore",
        "is_anomaly_zscore",
        "zscore_threshold",
        F.round("decision", 6).alias("iforest_score"),
        F.col("is_outlier").alias("is_anomaly_iforest"),
        (F.col("is_anomaly_zscore") & F.col("is_outlier")).alias("is_anomaly_consensus"),
        F.lit(MODEL_VERSION).alias("model_version"),
        C.as_of_ts(as_of).alias("detected_at"),
    )


def detection_summary(anomalies: DataFrame) -> DataFrame:
    """Run summary: rows, flags per detector, symbols."""
    return anomalies.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_anomaly_zscore").alias("anom_zscore"),
        F.count_if("is_anomaly_iforest").alias("anom_iforest"),
        F.count_if("is_anomaly_consensus").alias("anom_consensus"),
        F.countDistinct("symbol").alias("symbols"),
    )
