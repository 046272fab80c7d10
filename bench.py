"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1
timed run after one warm-up of the session).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "stg_ticks", "stg_posts", "dim_coin", "hourly_bars", "hourly_bars_keyed", "market_snapshot_hourly",
    "sentiment_daily", "top_movers_daily", "social_vs_price", "zscore_flags", "price_anomalies",
    "lexicon_sentiment", "anomaly_alerts", "kpi_latest", "price_hourly_view", "market_latest_view",
    "measure_prices", "measure_market", "symbol_health", "tick_tail", "pending_alerts", "upsert_update",
    "stream_ticks_available_now", "dq_orders_lineitem", "dq_ticks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "tidemark-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        catalog.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    once("hourly_bars")  # starts the session's machinery, not timed
    seconds = {name: round(statistics.median(once(name) for _ in range(runs)), 3) for name in HEADLINE}
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
