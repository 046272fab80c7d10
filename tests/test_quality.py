"""NULL rules, missing tables, criticality and freshness of the checks."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.plans import suites


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0, 1), (2, "b", None, 9), (2, None, -1.0, 9), (None, "z", 0.0, None)],
        "id INT, kind STRING, x DOUBLE, parent INT",
    )


def outcome(spark, table, *checks, **others):
    rows = Q.run_suites(spark, {"s": Q.Suite("t", checks, critical=True)}, {"t": table, **others}).collect()
    return {(r.check, r.target): (r.success, r.unexpected_count) for r in rows}


def test_rules(spark, table):
    parent = spark.createDataFrame([(1,), (None,)], "pid INT")
    out = outcome(
        spark, table,
        *Q.not_null("id", "kind"), Q.unique("id"), Q.unique("id", "kind"),
        Q.accepted_values("kind", ["a", "b"]), Q.not_accepted_values("kind", ["z", " "]),
        Q.between("x", 0), Q.between("x", 0, strict_low=True), Q.between("x", high=1), Q.expression("x", ">= 0"),
        Q.pair_at_least("parent", "id"), Q.relationship("parent", "p", "pid"), Q.columns_present("id", "nope"),
        p=parent,
    )
    assert out[("not_null", "id")] == (False, 1)
    assert out[("unique", "id")] == (False, 2)  # NULLs are not compared
    assert out[("unique", "id,kind")] == (True, 0)
    assert out[("accepted_values", "kind")] == (False, 1)  # NULL passes
    assert out[("not_accepted_values", "kind")] == (False, 1)
    assert out[("expression >= 0", "x")] == (False, 1)  # NULL passes
    assert out[("pair_at_least", "parent,id")] == (True, 0)
    assert out[("relationship", "parent")] == (False, 2)
    assert out[("columns_present", "id,nope")] == (False, 1)


def test_empty_passes_missing_fails(spark, table):
    checks = [*Q.not_null("id"), Q.unique("id"), Q.between("x", 0)]
    assert all(ok for ok, _ in outcome(spark, table.limit(0), *checks).values())
    assert outcome(spark, None, *checks) == {("table_exists", "t"): (False, 1)}
    assert not outcome(spark, table, Q.relationship("parent", "gone", "x"))[("relationship", "parent")][0]


def test_failing_values_are_samples(spark, table):
    got = {(r.check, r.target): r.samples for r in Q.failing_values(table, [Q.accepted_values("kind", ["a", "b"]), *Q.not_null("id"), Q.unique("id")]).collect()}
    assert got == {("accepted_values", "kind"): ["z"], ("not_null", "id"): ["NULL"]}


def test_failing_samples_are_bounded_and_one_scan(spark):
    many = spark.range(1000).select(F.col("id").alias("v"), F.lit(-1).alias("w"))
    df = Q.failing_values(many, [Q.between("v", 0, 1), Q.between("w", 0)])
    assert df._jdf.queryExecution().executedPlan().toString().count("Range (") == 1
    got = {r.target: r.samples for r in df.collect()}
    assert len(set(got["v"])) == 10 and got["w"] == ["-1"]
    smallest = {}
    for v in map(str, range(2, 1000)):
        h = hashlib.md5(v.encode()).hexdigest()
        smallest[h[0]] = min(smallest.get(h[0], h + v), h + v)
    assert got["v"] == [x[32:] for x in sorted(smallest.values())[:10]]


def test_checkpoint_writes_results_and_raises_on_critical(spark, table, tmp_path):
    good, soft, bad = (
        Q.Suite("t", (Q.between("x", -5),)), Q.Suite("t", (Q.between("x", 0),)), Q.Suite("t", (Q.unique("id"),), True),
    )
    tables, path = {"t": table}, str(tmp_path / "dq")
    report = Q.checkpoint(spark, {"good": good, "soft": soft}, tables, "run1", path)
    assert {r.suite: r.success for r in report.collect()} == {"good": True, "soft": False}
    with pytest.raises(Q.QualityFailure, match="bad"):
        Q.checkpoint(spark, {"bad": bad, "good": good}, tables, "run2", path)
    with pytest.raises(Q.QualityFailure):
        Q.checkpoint(spark, {"bad": bad, "good": good}, tables, "run3", path, fail_fast=True)
    stored = spark.read.json(path)
    assert {(r.run_id, r["count"]) for r in stored.groupBy("run_id").count().collect()} == {
        ("run1", 2), ("run2", 2), ("run3", 1),
    }
    assert Q.checkpoint(spark, {"bad": bad, "good": good}, tables, "run4", only="good").count() == 1


def test_declared_suites_have_the_expected_size(spark):
    sizes = {n: len(s.checks) for n, s in suites.business_suites().items()}
    assert sizes == {"raw_ticks": 7, "fact_prices_hourly": 8, "mart_anomaly_alerts": 7, "reddit_sentiment": 7}
    assert {n for n, s in suites.business_suites().items() if s.critical} == {"raw_ticks", "fact_prices_hourly"}


def test_freshness_levels(spark):
    def source(when):
        return spark.createDataFrame([(when,)], "t TIMESTAMP")

    sources = {"ok": source(datetime(2024, 1, 1, 11, 56)), "warn": source(datetime(2024, 1, 1, 11, 50)),
               "late": source(datetime(2024, 1, 1, 11, 0)), "none": source(None).limit(0)}
    rules = {n: Q.Freshness("t", 5, 30) for n in sources}
    out = {r.source: r.status for r in Q.freshness(sources, rules, "2024-01-01 12:00:00").collect()}
    assert out == {"ok": "pass", "warn": "warn", "late": "error", "none": "error"}
