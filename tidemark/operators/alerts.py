"""Alert selection, message text and the ledger of sent alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import columns as C

MIN_SEVERITY = 3.0
LOOKBACK_HOURS = 6
EXPLAINER_ROWS = 200  # fixed value: alerts offered for explanation


def alert_key(symbol: Column | str = "symbol", hour: Column | str = "ts_hour") -> Column:
    return F.concat(symbol, F.lit("|"), F.date_format(hour, "yyyyMMddHHmm"))


def pending_alerts(
    view: DataFrame,
    ledger: DataFrame,
    min_severity: float = MIN_SEVERITY,
    lookback_hours: int = LOOKBACK_HOURS,
    as_of: C.AsOf = None,
    retry_failed: bool = False,
) -> DataFrame:
    """Recent consensus alerts that are severe enough and not in the ledger, newest first.

    A failed delivery is in the ledger too and is not retried, unless ``retry_failed``.
    """
    handled = ledger.where("response_ok") if retry_failed else ledger
    return (
        view.where(
            F.col("is_anomaly_consensus")
            & (F.coalesce(F.col("severity"), F.lit(0)) >= min_severity)
            & (F.col("ts_hour") >= C.ago(as_of, lookback_hours, "hours"))
        )
        .select(
            alert_key().alias("alert_key"),
            "symbol",
            "coin_name",
            F.col("ts_hour").alias("event_hour"),
            "price_close",
            "hour_return_pct",
            "return_zscore",
            "severity",
            "severity_bucket",
            "detector_label",
            "fng_value",
            "fng_bucket",
            "reddit_mentions_day",
            "vader_compound_avg",
        )
        .join(handled.select("alert_key"), "alert_key", "left_anti")
        .orderBy(F.desc("event_hour"), F.desc_nulls_last("severity"), "symbol")
    )


def one_per_key(pending: DataFrame) -> DataFrame:
    """Coins that share a symbol share its alerts: the most severe row speaks for all, then the first coin by name."""
    order = Window.partitionBy("alert_key").orderBy(F.desc_nulls_last("severity"), "coin_name")
    return pending.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


# Stored scale of the figures in a message.
_STORED = {
    "price_close": "decimal(20,8)",
    "hour_return_pct": "decimal(10,4)",
    "return_zscore": "decimal(10,4)",
    "severity": "decimal(10,4)",
    "vader_compound_avg": "decimal(8,4)",
}


def _text(name: str, digits: int | None = None, suffix: str = "") -> Column:
    value = F.col(name)
    if digits is not None:
        # Rounds the exact binary value half to even, as the readers' tools do.
        pattern = F.lit("0." + "0" * digits)
        shown = F.call_function("format_number", value.cast("double"), pattern)
    else:
        shown = value.cast(_STORED[name]).cast("string") if name in _STORED else value.cast("string")
    return F.coalesce(F.concat(shown, F.lit(suffix)), F.lit("n/a"))


def alert_text(rounded: bool = False) -> Column:
    """Message of an alert, in the fixed layout its readers know.

    Figures have always been printed at their stored scale, since exact decimals slip past the
    rounding that was meant for them; ``rounded`` applies it (2 to 4 digits).
    """

    def figure(name: str, digits: int, suffix: str = "") -> Column:
        return _text(name, digits if rounded else None, suffix)

    arrow = F.when(F.coalesce(F.col("hour_return_pct"), F.lit(0)) < 0, "📉").otherwise("📈")
    hour = F.date_format("event_hour", "yyyy-MM-dd HH:mm:ss'+00:00'")
    parts: list[str | Column] = [
        "<b>", arrow, " Anomaly · ", F.col("symbol"), "</b>\n",
        "<i>", F.coalesce("coin_name", "symbol"), "</i> · <b>", F.coalesce("severity_bucket", F.lit("?")),
        "</b> (sev ", figure("severity", 2), ")\n\n",
        "• Hora: <code>", hour, "</code>\n",
        "• Precio close: <code>", figure("price_close", 4), "</code>\n",
        "• Retorno hora: <code>", figure("hour_return_pct", 3, " %"), "</code>\n",
        "• Z-score: <code>", figure("return_zscore", 2), "</code>\n",
        "• Detector: <code>", _text("detector_label"), "</code>\n",
        "• Fear &amp; Greed: <code>", _text("fng_value"), " (", _text("fng_bucket"), ")</code>\n",
        "• Reddit mentions: <code>", _text("reddit_mentions_day"), "</code>\n",
        "• VADER avg: <code>", figure("vader_compound_avg", 3), "</code>\n",
    ]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def ledger_rows(delivered: DataFrame, sent_at: C.AsOf | datetime = None) -> DataFrame:
    """Ledger entries for alerts with a ``response_ok`` column; written insert-if-absent on the alert key."""
    return delivered.select(
        "alert_key",
        "symbol",
        "event_hour",
        F.col("severity").cast("decimal(10,4)").alias("severity"),
        C.as_of_ts(sent_at).alias("sent_at"),
        "response_ok",
    )


def explainer_alerts(
    view: DataFrame, only_consensus: bool = True, min_severity: float = 0.0, rows: int = EXPLAINER_ROWS
) -> DataFrame:
    """The newest alerts (a top-k report), then the reader's filters, with display rounding and a label."""
    newest = view.orderBy(F.desc("ts_hour"), F.desc_nulls_last("severity"), "symbol").limit(rows)
    kept = newest.where(F.coalesce(F.col("severity"), F.lit(0)) >= min_severity)
    if only_consensus:
        kept = kept.where("is_anomaly_consensus")

    def rounded(name: str, digits: int) -> Column:
        return F.round(F.col(name).cast("double"), digits).alias(name)

    label = F.concat(
        "symbol", F.lit(" · "), F.date_format("ts_hour", "yyyy-MM-dd HH:mm"), F.lit(" · z="),
        _text("return_zscore", 2), F.lit(" · sev="), _text("severity", 2),
    )
    return kept.select(
        "ts_hour",
        "symbol",
        "coin_name",
        rounded("price_close", 4),
        rounded("hour_return_pct", 3),
        rounded("return_zscore", 3),
        rounded("severity", 2),
        "severity_bucket",
        "detector_label",
        "fng_bucket",
        label.alias("label"),
    )
