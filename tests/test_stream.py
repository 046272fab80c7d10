"""Ticker normalisation, decoding, the consumer and its restarts."""

import json
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import columns as C
from tidemark.operators import facts, monitoring, staging
from tidemark.plans import jobs
from tidemark.sources.warehouse import Warehouse
from tidemark.streaming import compaction as K, ticks as S

TICKER = {
    "e": "24hrTicker", "E": 1777012345678, "s": "QNTUSDT", "p": "-3.75", "P": "-4.1", "w": "88.20",
    "c": "87.75", "Q": "2.5", "o": "91.50", "h": "92.00", "l": "86.10", "v": "4321.5",
    "q": "381156.3", "n": 777, "b": "87.50", "a": "88.00",
}
AS_OF = "2026-05-01 00:00:00"


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_normalise_with_and_without_envelope(spark):
    payloads = values(spark, json.dumps({"stream": "btcusdt@ticker", "data": TICKER}), json.dumps(TICKER))
    a, b = S.normalize_tickers(payloads).collect()
    assert a == b and len(a) == 13
    assert (a.symbol, a.event_time, a.price, a.price_change, a.price_change_pct) == (
        "QNTUSDT", 1777012345678, 87.75, -3.75, -4.1,
    )
    assert (a.volume_base, a.trades_count, a.bid, a.ask) == (4321.5, 777, 87.5, 88.0)


def test_message_roundtrip_through_decode(spark):
    ticks = S.normalize_tickers(values(spark, json.dumps(TICKER)))
    message = S.to_messages(ticks)
    assert message.first().key == "QNTUSDT"
    row = S.good_ticks(S.decode(message, AS_OF)).first()
    assert len(row) == 10 and row.symbol == "QNTUSDT" and float(row.price) == 87.75
    assert row.event_time == datetime(2026, 4, 24, 6, 32, 25, 678000)


def test_dead_letters_and_reasons(spark):
    full = {f: 1 for f in S.REQUIRED_FIELDS} | {"symbol": "A"}
    texts = ["no json", json.dumps({"symbol": "BTCUSDT"}), json.dumps(full | {"price": None}), json.dumps(full | {"bid": None}), "[1]"]
    out = {r.value: r.reason for r in S.decode(values(spark, *texts), AS_OF).collect()}
    assert [out[t] for t in texts] == ["invalid_json", "missing_field", "bad_value", None, "invalid_json"]


def test_malformed_tickers_end_as_dead_letters(spark):
    raw = values(spark, json.dumps(TICKER | {"c": "abc"}), json.dumps({k: v for k, v in TICKER.items() if k != "c"}), "junk")
    decoded = S.decode(S.to_messages(S.normalize_tickers(raw)), AS_OF)
    assert S.good_ticks(decoded).count() == 0 and S.dead_letters(decoded).count() == 3


@pytest.fixture()
def topic(spark, tmp_path):
    def add(name, *symbols):
        rows = [json.dumps({f: 1 for f in S.REQUIRED_FIELDS} | {"symbol": s, "event_time": 1700000000000 + i}) for i, s in enumerate(symbols)]
        (tmp_path / "topic").mkdir(exist_ok=True)
        (tmp_path / "topic" / name).write_text("\n".join([*rows, "broken"]))

    return add


def consume(spark, tmp_path):
    messages = S.read_messages(spark, "text", {"path": str(tmp_path / "topic"), "maxFilesPerTrigger": "1"})
    query = S.ingest(messages, str(tmp_path / "out"), str(tmp_path / "checkpoint"), AS_OF, available_now=True)
    query.awaitTermination()
    return query


def test_consumer_resumes_without_loss_or_doubles(spark, tmp_path, topic):
    topic("a.txt", "A", "B")
    topic("b.txt", "C")
    query = consume(spark, tmp_path)
    assert sum(p.get("consumed", 0) for p in S.throughput(query)) == 5
    topic("c.txt", "D", "A")
    consume(spark, tmp_path)
    assert sorted(r.symbol for r in S.read_ticks(spark, str(tmp_path / "out")).collect()) == ["A", "A", "B", "C", "D"]
    assert S.read_dead_letters(spark, str(tmp_path / "out")).count() == 3


def test_a_repeated_batch_overwrites_itself(spark, tmp_path):
    decoded = S.decode(values(spark, json.dumps({f: 1 for f in S.REQUIRED_FIELDS} | {"symbol": "A"})), AS_OF)
    from pyspark.sql import functions as F

    for batch in (0, 0, 1):
        S._save(S.good_ticks(decoded).withColumn("dt", F.to_date("event_time")), str(tmp_path / "o/ticks"), batch, ["dt"])
    assert S.read_ticks(spark, str(tmp_path / "o")).count() == 2


def test_drain_stops_a_running_query(spark, tmp_path, topic):
    topic("a.txt", "A")
    messages = S.read_messages(spark, "text", {"path": str(tmp_path / "topic")})
    query = S.ingest(messages, str(tmp_path / "out"), str(tmp_path / "cp"), AS_OF, seconds=1)
    S.drain(query)
    assert not query.isActive and S.read_ticks(spark, str(tmp_path / "out")).count() == 1


def test_publish_to_files(spark, tmp_path):
    S.publish(S.to_messages(S.normalize_tickers(values(spark, json.dumps(TICKER)))), "json", {"path": str(tmp_path / "t")})
    assert spark.read.json(str(tmp_path / "t")).first().key == "QNTUSDT"


def test_freshness_monitor(spark):
    ticks = spark.createDataFrame([("A", datetime(2024, 1, 1, 12))], "symbol STRING, event_time TIMESTAMP")
    assert monitoring.check_freshness(ticks, "2024-01-01 12:10:00") == 10
    with pytest.raises(monitoring.StaleStream, match="10.5"):
        monitoring.check_freshness(ticks, "2024-01-01 12:10:30")
    with pytest.raises(monitoring.StaleStream, match="no ticks"):
        monitoring.check_freshness(ticks.limit(0), "2024-01-01")
    lights = {m: monitoring.symbol_health(ticks, f"2024-01-01 12:{m:02d}:00").first().status for m in (4, 5, 15)}
    assert lights == {4: "🟢", 5: "🟡", 15: "🔴"}


# ---- admission, commits, compaction, incremental bars -----------------------------------------


def message(symbol, at, price, volume=5.0):
    return json.dumps({f: 1 for f in S.REQUIRED_FIELDS} | {"symbol": symbol, "event_time": at, "price": price, "volume_base": volume, "bid": price, "ask": price})


def hour(day, h, minute=0):
    return int(datetime(2024, 1, day, h, minute, tzinfo=timezone.utc).timestamp() * 1000)


def deliver(spark, tmp_path, *records):
    (tmp_path / "topic").mkdir(exist_ok=True)
    (tmp_path / "topic" / f"{len(list((tmp_path / 'topic').iterdir()))}.txt").write_text("\n".join(records))
    consume(spark, tmp_path)
    return str(tmp_path / "out")


def test_a_batch_is_due_at_so_many_rows_or_seconds(spark, tmp_path, topic):
    assert S.admission("kafka") == {"minOffsetsPerTrigger": "500", "maxTriggerDelay": "5s", "maxOffsetsPerTrigger": "500000"}
    assert S.admission("text", rows_per_file=100) == {"maxFilesPerTrigger": "5"}
    for i in range(3):
        topic(f"{i}.txt", "A", "B")
    messages = S.read_messages(spark, "text", {"path": str(tmp_path / "topic")})
    S.ingest(messages, str(tmp_path / "out"), str(tmp_path / "cp"), AS_OF, available_now=True).awaitTermination()
    counted = {r.batch_id: (r.consumed, r.inserted, r.dead_letters) for r in S.batch_counters(spark, str(tmp_path / "out")).collect()}
    assert counted == {0: (3, 2, 1), 1: (3, 2, 1), 2: (3, 2, 1)}  # a backlog of files is taken in several batches
    assert S.read_ticks(spark, str(tmp_path / "out")).count() == 6


def test_closed_days_move_once(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "warehouse"))
    w.write_batch("ticks", C.conform(spark.createDataFrame([("OLD", datetime(2024, 1, 1, 5), 1.0)], "symbol STRING, event_time TIMESTAMP, price DOUBLE"), schemas.ticks()))
    root = deliver(spark, tmp_path, message("AUSDT", hour(1, 9), 1), message("AUSDT", hour(2, 9), 2))
    assert K.compact(w, root, "2024-01-02 12:00:00") == 1  # the second day is still open
    deliver(spark, tmp_path, message("BUSDT", hour(1, 10), 3))  # late
    everything = lambda: sorted((r.symbol, r.event_time.day) for r in K.all_ticks(w, root).collect())
    assert everything() == [("AUSDT", 1), ("AUSDT", 2), ("BUSDT", 1), ("OLD", 1)]
    # interrupted after the day was rewritten, before it was logged
    before = spark.read.parquet(f"{root}/moved").collect()
    assert K.compact(w, root, "2024-01-02 12:00:00") == 1
    moved = Path(root) / "moved"
    moved.rename(tmp_path / "elsewhere")
    spark.createDataFrame(before, K.LOG_DDL).write.parquet(str(moved))
    deliver(spark, tmp_path, message("CUSDT", hour(1, 11), 3))
    K.compact(w, root, "2024-01-02 12:00:00")
    assert everything().count(("BUSDT", 1)) <= 1 and ("CUSDT", 1) in everything()
    assert not list((Path(root) / "ticks" / "dt=2024-01-01").glob("batch_id=*"))
    days = [d.name for d in Path(w.path("ticks")).iterdir() if d.is_dir()]
    assert days == ["dt=2024-01-01"] and len(list((Path(w.path("ticks")) / days[0]).glob("*.parquet"))) == 1


def test_late_ticks_change_their_bar_and_the_next(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "warehouse"))
    coins = spark.createDataFrame([("ka", "a", "A"), ("kb", "b", "B"), ("kb2", "b2", "B")], "coin_key STRING, coin_id STRING, symbol STRING")
    many = [message(s, hour(d, h, m), 100 + d + h + m / 60, d * 100 + h) for s in ("AUSDT", "BUSDT") for d, h in ((1, 22), (1, 23), (3, 4), (14, 0)) for m in (1, 2)]
    root = deliver(spark, tmp_path, *many)

    def rebuilt():
        whole = facts.fact_prices_hourly(staging.stg_ticks(K.all_ticks(w, root)), coins, 2, AS_OF)
        return sorted(map(str, whole.collect()))

    def stored():
        return sorted(map(str, w.read("fact_prices_hourly").collect()))

    refresh = lambda: jobs.refresh_stream_bars(w, root, coins, 2, AS_OF)
    assert [d.day for d in refresh()] == [1, 3, 14] and stored() == rebuilt()
    assert refresh() == []
    deliver(spark, tmp_path, message("AUSDT", hour(1, 23, 59), 500, 7), message("AUSDT", hour(14, 1, 1), 3, 1))
    assert [d.day for d in refresh()] == [1, 3] and stored() == rebuilt()  # one tick is no bar yet
    deliver(spark, tmp_path, message("AUSDT", hour(14, 1, 2), 4, 2), message("CUSDT", hour(2, 1, 2), 4, 2), message("CUSDT", hour(2, 1, 3), 4, 2))
    assert [d.day for d in refresh()] == [2, 14] and stored() == rebuilt()
    deliver(spark, tmp_path, message("CUSDT", hour(28, 1, 2), 4, 2), message("CUSDT", hour(28, 1, 3), 4, 2))
    assert [d.day for d in refresh()] == [28] and stored() == rebuilt()  # its last bar lies beyond the look-back


def test_published_order(spark, tmp_path):
    rows = [(s, i, 1.0) for i in range(50) for s in ("A", "B", "C", "D", "E", "F", "G")]
    ticks = spark.createDataFrame(rows, "symbol STRING, event_time BIGINT, price DOUBLE").repartition(5)
    S.publish(S.to_messages(ticks, keep=["event_time"]), "parquet", {"path": str(tmp_path / "t")}, order=["event_time"])
    sent = spark.read.parquet(str(tmp_path / "t")).select("*", "_metadata.file_path", "_metadata.row_index").collect()
    seen = {}
    for r in sorted(sent, key=lambda r: (r.file_path, r.row_index)):
        at = json.loads(r.value)["event_time"]
        assert 0 <= r.partition < 6 and seen.setdefault(r.key, (r.partition, r.file_path, -1))[:2] == (r.partition, r.file_path)
        assert at > seen[r.key][2]
        seen[r.key] = (r.partition, r.file_path, at)


def test_published_runs(spark, tmp_path):
    """The task that writes a topic partition sorts few compressed runs; equal instants, null keys and no rows are fine."""
    rows = [(s, i // 3, float(i)) for i in range(900) for s in ("A", "B", None)]
    ticks = spark.createDataFrame(rows, "symbol STRING, event_time BIGINT, price DOUBLE").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        messages = S.to_messages(ticks, keep=["event_time", "price"])
        runs = S._packed(messages, ["event_time", "price"]).count()
        assert 2700 / 50 <= runs < 2700 / 10
        S.publish(messages, "parquet", {"path": str(tmp_path / "t")}, order=["event_time", "price"])
        S.publish(messages.limit(0), "parquet", {"path": str(tmp_path / "none")}, order=["event_time"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sent = spark.read.parquet(str(tmp_path / "t"))
    assert sent.columns == ["key", "value", "partition"] and spark.read.parquet(str(tmp_path / "none")).count() == 0
    by_key = {}
    for r in sorted(sent.select("*", "_metadata.file_path", "_metadata.row_index").collect(), key=lambda r: (r.file_path, r.row_index)):
        by_key.setdefault(r.key, []).append((r.partition, r.file_path, json.loads(r.value)["price"]))
    for got in by_key.values():
        assert len({x[:2] for x in got}) == 1 and [x[2] for x in got] == [float(i) for i in range(900)]
    assert len(by_key) == 3


def test_roundtrip_meets_the_ends_of_stretches(spark, sf_dir, monkeypatch):
    from tidemark.plans import catalog

    def shuffled(m, fmt, options, order):
        m.drop(*order).repartition(2, "partition").sortWithinPartitions(F.xxhash64("value")).write.parquet(options["path"])

    whole = catalog.run("publish_roundtrip", spark, sf_dir).collect()
    assert all(r.inversions == 0 and r.files == 1 for r in whole)
    monkeypatch.setattr(catalog.stream, "publish", shuffled)
    found = []
    for rows in (10**9, 7, 1):  # at 1 every pair lies over an end
        monkeypatch.setattr(catalog, "STRETCH_ROWS", rows)
        found.append(sorted(catalog.run("publish_roundtrip", spark, sf_dir).collect()))
    assert found[0] == found[1] == found[2] and all(r.inversions > 0 for r in found[0])
