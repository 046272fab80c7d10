import math
import random
from collections import Counter, defaultdict

from tidemark.llm import kn_quality as Q


def brute(train, order):
    """An interpolated modified Kneser-Ney byte model, straight from its definition."""
    grams = [Counter() for _ in range(order + 1)]
    for t in train:
        data = b"\n" * order + t.encode()
        for i in range(order, len(data)):
            grams[order][data[i - order : i + 1]] += 1
    for k in range(order, 0, -1):
        for g in grams[k]:
            grams[k - 1][g[1:]] += 1
    discounts, context = [], []
    for k in range(order + 1):
        n = [sum(c == i for c in grams[k].values()) for i in range(5)]
        discounts.append(Q.Discounts(n[1:]).by_count)
        table = defaultdict(list)
        for g, c in grams[k].items():
            table[g[:-1]].append(c)
        context.append(table)

    def p(g):
        k = len(g) - 1
        below = p(g[1:]) if k else 1 / 256
        seen = context[k].get(g[:-1])
        if not seen:
            return below
        d = discounts[k]
        c = grams[k][g]
        return (c - d[min(c, 3)]) / sum(seen) + sum(d[min(x, 3)] for x in seen) / sum(seen) * below

    def perplexity(t):
        data = b"\n" * order + t.encode()
        bits = [-math.log2(p(data[i - order : i + 1])) for i in range(order, len(data))]
        return 2 ** (sum(bits) / len(bits)) if bits else None

    return perplexity


def test_matches_brute_force(spark, frame, monkeypatch):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    rows = [(i, make(rng.randrange(5, 60))) for i in range(40)] + [(90, None), (91, ""), (92, "XYZ" * 2000), (None, "abc"), (3, "abc"), (3, "abc")]
    trusted = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    perplexity = brute([t for i, t in rows if i is not None and i < 20], 3)
    want = [(str(i), None if not t else round(perplexity(t), 3)) for i, t in rows]
    for blocks in (Q.SALT_BLOCKS, 1):  # also with counts that are copied for every block
        monkeypatch.setattr(Q, "SALT_BLOCKS", blocks)
        monkeypatch.setattr(Q.B, "BLOCK_BYTES", 1024 if blocks == 1 else Q.B.BLOCK_BYTES)
        got = Q.perplexity(frame(rows), trusted, order=3, shards=4).collect()
        assert sorted(map(str, ((str(r.doc_id), r.perplexity and round(r.perplexity, 3)) for r in got))) == sorted(map(str, want))


def test_probabilities_sum_to_one():
    import numpy as np

    from tidemark.llm import ngrams as N

    data = np.frombuffer(b"abracadabra abra", np.uint8)
    key, count = N.summed(N.keys(data, np.array([0, len(data)]), 3), np.ones(len(data), np.int64))
    levels = Q.orders(key, count, 3, 1)
    d = {k: Q.Discounts(np.bincount(np.minimum(c, 5), minlength=6)[1:5]) for k, (_, c) in levels.items()}
    d[0] = Q.Discounts([3, 1, 1, 0])
    low = Q.Low(levels[1], d[0], d[1])
    for context in (b"bra", b"zzz", b"cad", b" ab"):
        base = context[2] << 16 | context[1] << 8 | context[0]
        asked = np.array([(s << 24) + base for s in range(256)], np.uint64)
        assert math.isclose(np.exp2(Q.shard_log2(asked, key, count, 3, d, low)).sum(), 1, rel_tol=1e-9)


def test_thresholds_by_language(spark, frame):
    rng = random.Random(5)
    word = lambda a: "".join(rng.choice(a) for _ in range(4))
    rows = [(i, " ".join(word("abcd") for _ in range(30)), "en" if i % 2 else None) for i in range(80)]
    rows += [(100, "ሴ" * 50), (101, None), (102, ""), (103, rows[0][1], "xx")]
    labels = [(i, 1) for i in range(60)] + [(100, 0), (None, 1), (5, 1), (9999, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.classify(frame(rows), labels).collect()}
    assert len(got) == len(rows)
    assert not got[100].keep and not got[101].keep and not got[102].keep and got[101].perplexity is None
    assert got[103].keep and sum(got[i].keep for i in range(80)) >= 70
    assert len({got[i].threshold for i in range(80)}) == 2


def test_empty_tables(spark, frame):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert Q.classify(frame([]), labels).count() == 0
    (row,) = Q.classify(frame([(1, "abc")]), labels).collect()
    assert row.keep and math.isclose(row.perplexity, 256, rel_tol=1e-6)


def test_accuracy_against_labels(spark, sf_dir):
    """Of the labelled documents that the model did not learn from, good ones are kept and bad ones dropped."""
    from tidemark.llm import queries

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = Q.sample(labels.where("quality = 1"), "doc_id", Q.TRUSTED_ROWS)
    judged = queries.op1_quality_classifier(spark, sf_dir).join(labels.join(learned, "doc_id", "left_anti"), "doc_id").collect()
    good, bad = ([r.keep for r in judged if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.9 * len(good) > 0 and (not bad or sum(bad) <= 0.2 * len(bad))


def test_learns_from_all_of_the_first_part(spark):
    labels = spark.range(50_000).withColumnRenamed("id", "doc_id")
    assert Q.sample(labels, "doc_id", Q.TRUSTED_ROWS).count() == Q.part(labels, "doc_id", 0).count() > 24_000


def test_shards_follow_the_trusted_text(spark, frame, monkeypatch):
    """More shards, shuffled ids: the same perplexities."""
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("abcd ") for _ in range(40))) for i in range(30)]
    trusted = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    perplexity = brute([t for i, t in rows if i < 20], 3)
    monkeypatch.setattr(Q, "SHARDS", 2)
    monkeypatch.setattr(Q, "SHARD_TEXT", 100)
    monkeypatch.setattr(Q, "MAX_BROADCAST_IDS", 5)
    seen, counts = [], Q.N.counts
    monkeypatch.setattr(Q.N, "counts", lambda *a: seen.append(a[4]) or counts(*a))
    got = {r.doc_id: r.perplexity for r in Q.perplexity(frame(rows), trusted, order=3).collect()}
    assert seen == [8] and all(math.isclose(got[i], perplexity(t), rel_tol=1e-4) for i, t in rows)
