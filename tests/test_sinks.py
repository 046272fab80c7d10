"""Landing parsers, bronze partitions, keyed tables."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import bronze, landed
from tidemark.sources.warehouse import Warehouse, merge_rows

NOW = datetime(2024, 3, 1, 12)


def write_json(path, *documents):
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def test_market_payload(spark, tmp_path):
    coins = [
        {"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 51250.5, "market_cap": 10**12,
         "last_updated": "2024-02-29T11:22:33.000Z", "ath_date": "garbage", "extra": 1},
        {"id": "monero", "symbol": "xmr", "name": "Monero", "current_price": 160, "atl_date": "2014-01-14T12:00:00Z"},
    ]
    raw = landed.read_payload(spark, write_json(tmp_path / "m.json", *coins), "markets")
    rows = landed.market_rows(raw, NOW)
    assert {"_ingested_at", "_source", "_dataset"} <= set(rows.columns)
    out = {r.id: r for r in landed.to_landing(rows, schemas.markets()).collect()}
    assert out["bitcoin"].last_updated == datetime(2024, 2, 29, 11, 22, 33)
    assert out["bitcoin"].ath_date is None and out["monero"].atl_date == datetime(2014, 1, 14, 12)
    assert out["bitcoin"].ingested_at == NOW and out["bitcoin"].market_cap_rank is None
    assert list(out["bitcoin"].asDict()) == schemas.markets().fieldNames()


def test_whole_file_payload_and_empty_payload(spark, tmp_path):
    (tmp_path / "all.json").write_text(json.dumps([{"id": "a"}, {"id": "b"}], indent=1))
    assert landed.read_payload(spark, str(tmp_path / "all.json"), "markets", whole_files=True).count() == 2
    (tmp_path / "none.json").write_text("[]")
    none = landed.read_payload(spark, str(tmp_path / "none.json"), "markets", whole_files=True)
    assert landed.market_rows(none, NOW).count() == 0


def test_index_payload(spark, tmp_path):
    doc = {"data": [{"value": "31", "value_classification": "Fear", "timestamp": "1735776000", "time_until_update": "410"}]}
    r = landed.index_rows(landed.read_payload(spark, write_json(tmp_path / "i.json", doc), "index"), NOW).first()
    assert (r.value, r.category, r.index_date) == (31, "Fear", datetime(2025, 1, 2))


def test_post_listing(spark, tmp_path):
    def child(**kw):
        return {"data": {"id": "x", "created_utc": 1700000000.0, "permalink": "/r/x", **kw}}

    doc = {"data": {"children": [
        child(title="T", selftext="s" * 3000, score=None, over_18=True),
        child(id="y", title=None),
        {"data": {"title": "no id", "created_utc": 1.0}},
        {"data": {"id": "no time"}},
    ]}}
    raw = landed.read_payload(spark, write_json(tmp_path / "p.json", doc), "posts")
    out = {r.id: r for r in landed.post_rows(raw, "bitcoin", NOW).collect()}
    assert set(out) == {"x", "y"}
    assert len(out["x"].selftext) == 3000 and out["x"].score == 0 and out["x"].over_18
    assert out["x"].permalink == "https://reddit.com/r/x" and out["y"].title == ""
    cut = landed.post_rows(raw, "bitcoin", NOW, body_chars=landed.ORIGINAL_BODY_CHARS).where("id = 'x'").first()
    assert len(cut.selftext) == 2000


def test_symbol_setting(spark):
    coins = landed.tracked_coins(spark, " btcusdt,ETHUSDT, ,nopeusdt,").orderBy("position")
    assert [(r.pair, r.coin_id) for r in coins.collect()] == [("BTCUSDT", "bitcoin"), ("ETHUSDT", "ethereum")]


def test_bronze_layout_rerun_and_inventory(spark, tmp_path):
    root = str(tmp_path / "bronze")
    df = spark.createDataFrame([(4, "low"), (5, "mid"), (6, "top")], "a BIGINT, b STRING")
    assert bronze.write_bronze(df.limit(0), root, "lab", "readings", NOW) == ""
    for _ in range(2):
        path = bronze.write_bronze(df, root, "lab", "readings", NOW)
    bronze.write_bronze(df.where("a = 4"), root, "lab", "readings", datetime(2024, 3, 1, 3))
    out = bronze.read_bronze(spark, root, "lab", "readings")
    assert sorted((r.a, r.dt, r.hh) for r in out.collect()) == [
        (4, "2024-03-01", "03"), (4, "2024-03-01", "12"), (5, "2024-03-01", "12"), (6, "2024-03-01", "12"),
    ]
    bronze.write_bronze(df, root, "lab", "readings", NOW, overwrite_partition=False)
    assert out.sparkSession.read.parquet(path).count() == 7
    files = bronze.inventory(spark, root).collect()
    assert files and all("/lab/readings/dt=2024-03-01/hh=" in f.key and f.size_kb > 0 for f in files)
    newest = bronze.newest_file(spark, root).first()
    assert newest.last_modified == max(f.last_modified for f in files)
    assert bronze.peek(spark, newest.key, 2).count() <= 2


COLUMNS = ["id", "title", "score"]
DDL = "id STRING, title STRING, score INT"


def state(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_modes(spark):
    old = spark.createDataFrame([("1", "a", 1), ("2", "b", 2)], DDL)
    new = spark.createDataFrame([("2", "changed", 9), ("3", "c", None)], DDL)
    assert state(merge_rows(old, new, COLUMNS, ["id"], ["score"]))[1:2] == [("2", "b", 9)]
    assert len(state(merge_rows(old, new, COLUMNS, ["id"], ["score"]))) == 3
    kept = merge_rows(old, new, COLUMNS, ["id"])
    assert ("2", "b", 2) in state(kept) and kept.count() == 3
    assert merge_rows(old, new, COLUMNS).count() == 4
    with pytest.raises(ValueError, match="score"):
        merge_rows(old, new.drop("score"), COLUMNS)


def test_update_writes_null_values_too(spark):
    old = spark.createDataFrame([("1", "a", 1)], DDL)
    new = spark.createDataFrame([("1", "a", None)], DDL)
    assert state(merge_rows(old, new, COLUMNS, ["id"], ["score"])) == [("1", "a", None)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([("1", float("nan"))], "id STRING, x DOUBLE")
    assert merge_rows(df.limit(0), df, ["id", "x"], ["id"]).first().x is None


def anomaly_rows(spark, rows):
    full = [(s, h, 1.0, 0.1, 1.0, z, True, 3.0, 0.1, False, False, "m", NOW) for s, h, z in rows]
    return spark.createDataFrame(full, schemas.anomalies())


def test_keyed_table_rewrites_only_touched_days(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    assert w.count("anomalies") == 0 and not w.exists("anomalies")
    d1, d2 = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5)
    w.write_batch("anomalies", anomaly_rows(spark, [("A", d1, 1.0), ("A", d2, 2.0)]))
    before = {f.key: f.last_modified for f in bronze.inventory(spark, w.path("anomalies")).collect()}
    later = anomaly_rows(spark, [("A", d2, 5.0), ("B", d2, 6.0)]).withColumn("detected_at", F.lit(datetime(2025, 1, 1)))
    for _ in range(2):
        w.write_batch("anomalies", later)
    out = {(r.symbol, r.event_hour): r for r in w.read("anomalies").collect()}
    assert len(out) == 3 and out["A", d2].return_zscore == 5.0
    assert out["A", d2].detected_at == NOW  # instant of the first write
    assert out["B", d2].detected_at == datetime(2025, 1, 1)
    after = {f.key: f.last_modified for f in bronze.inventory(spark, w.path("anomalies")).collect()}
    untouched = [k for k in before if "dt=2024-01-01" in k]
    assert untouched and all(after[k] == before[k] for k in untouched)
    with pytest.raises(ValueError, match="repeated"):
        w.write_batch("anomalies", anomaly_rows(spark, [("A", d1, 1.0), ("A", d1, 2.0)]))
    with pytest.raises(ValueError, match="missing or repeated"):
        w.write_batch("anomalies", anomaly_rows(spark, [(None, d1, 1.0)]))
    w.truncate("anomalies")
    assert w.count("anomalies") == 0
    w.write_batch("anomalies", later)
    assert w.count("anomalies") == 2


def test_append_table_and_mart(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    rows = spark.createDataFrame([("c", "c", "C", NOW)], "id STRING, symbol STRING, name STRING, ingested_at TIMESTAMP")
    w.write_batch("markets", rows)
    w.write_batch("markets", rows)
    w.write_batch("markets", rows.limit(0))
    assert w.count("markets") == 2
    w.write_mart("m", rows)
    assert w.write_mart("m", rows).count() == 1
    w.create_views(["m"], prefix="v_")
    assert spark.table("v_m").count() == 1
    w.truncate("m")
    assert w.count("m") == 0


def test_a_read_error_is_not_an_empty_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    assert not warehouse.exists("posts") and warehouse.count("posts") == 0
    (tmp_path / "w" / "posts" / "dt=2024-01-01").mkdir(parents=True)
    (tmp_path / "w" / "posts" / "dt=2024-01-01" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        warehouse.read("posts").count()


def test_scratch_on_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tidemark.session import shared_dir

    def session(master, named=None):
        conf = SimpleNamespace(get=lambda *_: named)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda _: None)))

    assert shared_dir(session("spark://host:7077", "hdfs:///shared/")) == "hdfs:///shared"
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("local[4]"))


def test_scratch_is_discarded_and_nothing_else(spark, tmp_path):
    from tidemark.session import discard, scratch_path, settle

    path = scratch_path(spark, "once")
    assert settle(spark.range(3), "once", path).count() == 3
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    spark.range(1).write.parquet(str(tmp_path / "mine"))
    with pytest.raises(ValueError):
        discard(spark, str(tmp_path / "mine"))
    assert spark.read.parquet(str(tmp_path / "mine")).count() == 1
