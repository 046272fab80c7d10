import math
import random

from tidemark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int, rank string, block int"


def brute(rows, k):
    good = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, q, a in good:
        if q % 5 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, i, b in good if m != n)[:k]
            out += [(q, r, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def check(spark, rows, k=3):
    import numpy as np

    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1, "r", 2) for i, v in rows], SCHEMA)
    got = topk.search(df, (topk.F.col("vec_id") % 5) == 0, k=k)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, k)


def test_matches_brute_force(spark, frame, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "PART_BUCKETS", 2)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.uniform(-2, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, [1.0, 0, 0, 0, 0, 0]) for i in range(200, 260)]  # one very common vector
    rows += [(300, None), (None, [1.0] * 6), (305, [float("nan")] * 6), (310, [float("inf"), 1, 1, 1, 1, 1]), (315, [None, 1.0])]
    rows += [(320, [0.0] * 6), (325, []), (330, [2.0, 1.0]), (335, [1.0] * 9), (-5, [-3.0] * 6), (7, [5.0] * 6), (10, [5.0] * 6), (10, [5.0] * 6)]
    check(spark, rows)


def test_prunes_without_losing(spark, frame):
    rng = random.Random(6)
    centre = [rng.gauss(0, 1) for _ in range(8)]
    check(spark, [(i, [c * (1 + i % 7) + rng.gauss(0, 0.05) for c in centre]) for i in range(80)], k=5)


def test_huge_and_few(spark, frame):
    check(spark, [(0, [3e38, 1.0]), (5, [3e38, 2.0]), (6, [-3e38, 0.5])])
    check(spark, [(0, [1.0])])
    check(spark, [])


def test_short_parts_are_not_met():
    """Blocks of queries meet the parts that hold a vector long enough, and no others."""
    assert topk.meetings([0.0, 3.0, 3.5, 100.0], [9.0, 5.0, 3.0, 1.0]) == [4, 3, 2, 0]


def test_fewer_pairs_than_all(spark, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET", 16)
    monkeypatch.setattr(topk, "PART_BUCKETS", 2)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    met = []
    monkeypatch.setattr(topk, "meetings", lambda needs, tops, f=topk.meetings: met.append((f(needs, tops), len(tops))) or met[-1][0])
    rng = random.Random(7)
    check(spark, [(i, [abs(rng.gauss(0, 1)) * 1.02 ** (i % 200) for _ in range(6)]) for i in range(300)])
    counts, parts = met[0]
    assert sum(counts) < len(counts) * parts
