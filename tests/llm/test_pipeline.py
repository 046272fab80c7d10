import random
import re

import corpus_pipeline as P
import test_decontaminate as decontamination
import test_packing as packing
import test_secret_scan as secrets

import pyarrow as pa
from pyspark.sql.functions import lit, repeat

from tidemark.session import BATCH_LIMIT, settle

SECRET = "password=0123456789abcdef"


def components(rows, size=5, percent=80):
    """The smallest id of the near copies of each row by comparing all pairs; rows without words are alone."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    return [min((rows[b][0] is None, rows[b][0] or 0) for b in range(len(rows)) if label[b] == label[a]) for a in range(len(rows))]


def corpus():
    rng = random.Random(8)
    vocabulary = ["the", "cat", "sees", "a", "dog", "and", "runs", "home", "again", "today"]
    text = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(50)) for _ in range(n))
    rows = [(i, text(60), "en") for i in range(30)]
    rows += [(40 + i, rows[i][1], "en") for i in range(5)] + [(50, rows[0][1] + " extra", "en"), (51, rows[2][1].upper(), "en")]
    rows += [(60, None, "en"), (61, "", "en"), (62, "123 456 !!", "en"), (None, text(30), None)]
    bench = [(1, rows[7][1]), (2, text(40)), (3, None)]
    rows += [(70, text(20) + " " + bench[1][1], "en"), (71, text(400) + " " + " ".join(bench[1][1].split()[:14]), "en")]
    # near copies: four of 200 words changed, similarity 0.82 to 0.88
    for i in range(30):
        whole = text(200).split()
        copy = list(whole)
        for at in rng.sample(range(10, 190), 4):
            copy[at] = "changed"
        rows += [(1000 + i, " ".join(whole), "en"), (2000 + i, " ".join(copy), "en")]
    rows += [(80, f"{text(20)} {SECRET} {text(20)}", "en"), (81, f"{text(20)} AKIA{'Q' * 16} {text(20)}", "en")]
    return rows, bench


def test_stages_by_brute_force(spark, frame, tmp_path):
    rows, bench = corpus()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, g, "s", t if t is None else len(t)) for i, t, g in rows], columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in P.STAGES:
        docs = settle(stage(spark, docs, str(tmp_path)), "test-stage")
        kept[name] = docs
        if name != "packing":
            assert docs.schema == spark.read.parquet(str(tmp_path / "documents.parquet")).schema
    pairs = lambda name: sorted(((r.doc_id, r.text) for r in kept[name].collect()), key=str)
    # language ID: what has no letter goes
    want = [(i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    assert pairs("language_id") == sorted(want, key=str)
    # one of each component
    want = [w for w, first in zip(want, components(want)) if (w[0] is None, w[0] or 0) == first]
    assert not {doc for doc, _ in want} & set(range(2000, 2030)) and {doc for doc, _ in want} >= set(range(1000, 1030))
    assert pairs("near_duplicates") == sorted(want, key=str)
    bad = {doc for doc, *_, hit in decontamination.brute(want, bench, 13) if hit}
    assert bad == {7, 70}
    want = [w for w in want if w[0] not in bad]
    assert pairs("decontamination") == sorted(want, key=str)
    masked = []
    for doc, t in want:
        for span in reversed(secrets.brute(t)):
            _, a, b = span.rsplit(":", 2)
            t = t[: int(a)] + "[SECRET]" + t[int(b) :]
        masked.append((doc, t))
    assert pairs("secrets") == sorted(masked, key=str) and sum("[SECRET]" in t for _, t in masked) == 2
    assert all(r.n_chars == len(r.text) for r in kept["secrets"].collect())
    packing.check(masked, kept["packing"].collect(), 2048)
    run = P.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, kept["packing"].collect()))


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls, ties, repeated rows, a very long text and columns named like helpers, in every stage that keeps documents."""
    names = "doc_id long, text string, lang string, source string, n_chars long, __cid string, __doc long, __set int, __blob int, __cuts int, __hits int, blob int, cid int"
    long = "one two three four five " * 60_000 + SECRET
    texts = [(1, None), (1, ""), (2, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, long), (3, f"x {SECRET} y")]
    docs = spark.createDataFrame([(i, t, None, None, None, "x", 1, 2, 3, 4, 5, 6, 7) for i, t in texts], names)
    spark.createDataFrame([(None, None), (1, ""), (1, "p q r")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage, left in (("near_duplicates", P.near_duplicates, 5), ("decontamination", P.decontamination, 7), ("secrets", P.secrets, 7)):
        got = stage(spark, docs, str(tmp_path))
        assert got.schema == docs.schema and got.count() == left, name
    assert sum("[SECRET]" in (r.text or "") for r in got.collect()) == 2
    known = P.language_id(spark, docs.withColumn("lang", lit("en")), str(tmp_path)).collect()
    assert all(r.text for r in known) and long in {r.text for r in known}
    assert {r.doc_id for r in P.pack(spark, docs, str(tmp_path)).collect()} == {None, 1, 2, 3}


def test_workers_get_bounded_batches(spark, tmp_path):
    """After any stage was called, 24 MB of long texts in one task reach a Python worker in batches of about 4 MB."""
    spark.createDataFrame([(1, "p q r")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(i, "one two three " * 5, "en", "s", 70) for i in range(8)], "doc_id long, text string, lang string, source string, n_chars long")
    long = spark.range(0, 96, 1, 1).select("id", repeat(lit("x"), 250_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    set_before = spark.conf.get(BATCH_LIMIT)
    try:
        for name, stage in P.STAGES:
            spark.conf.unset(BATCH_LIMIT)
            stage(spark, docs, str(tmp_path))
            got = long.mapInArrow(sizes, "n long, size long").collect()
            assert sum(r.n for r in got) == 96 and max(r.size for r in got) < 4_500_000, name
        spark.conf.set(BATCH_LIMIT, "1m")  # a smaller limit is kept
        stage(spark, docs, str(tmp_path))
        assert spark.conf.get(BATCH_LIMIT) == "1m"
    finally:
        spark.conf.set(BATCH_LIMIT, set_before)


def test_empty_corpus(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
