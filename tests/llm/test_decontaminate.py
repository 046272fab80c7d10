import random
import re

from tidemark.llm import decontaminate as D


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, bench, window):
    pats = {}
    for item, t in bench:
        w = words(t)
        m = min(window, len(w))
        for i in range(len(w) - m + 1) if m else ():
            pats.setdefault(tuple(w[i : i + m]), set()).add("" if item is None else str(item))
    out = []
    for doc, t in docs:
        w, hit, items = words(t), set(), set()
        for m in {len(p) for p in pats}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in pats:
                    hit.update(range(i, i + m))
                    items |= pats[tuple(w[i : i + m])]
        out.append((doc, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def bench_frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


def test_matches_brute_force(spark, frame, monkeypatch):
    rng = random.Random(3)
    vocabulary = ["Ab", "cd", "É9", "x", "naïve"]
    make = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "-", "\n", "_", "."]) for _ in range(n))
    bench = [(i, make(rng.randrange(0, 9))) for i in range(25)] + [(None, "solo item"), (4, "zz yy"), (9, None), (10, "...")]
    docs = [(i, make(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "zz yy"), (102, "zz yy"), (None, "ZZ_yy solo ITEM"), (103, make(3000)), (104, "q " * 700 + "zz yy")]
    want = sorted(map(str, brute(docs, bench, 5)))
    for chunk in (100_000, 7):
        monkeypatch.setattr(D, "CHUNK_WINDOWS", chunk)
        found = D.contamination(frame(docs), bench_frame(spark, bench), window=5).collect()
        assert sorted(str((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated)) for r in found) == want
        kept = D.drop_contaminated(frame(docs), bench_frame(spark, bench), window=5)
        assert kept.columns == frame(docs).columns
        assert kept.count() == sum(not b[-1] for b in brute(docs, bench, 5))


def test_empty_tables(spark, frame):
    assert D.contamination(frame([]), bench_frame(spark, [(1, "a b")])).count() == 0
    (row,) = D.contamination(frame([(1, "a b c")]), bench_frame(spark, [])).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)


def test_search_positions_stay_few():
    """Unrelated words move the search by nearly a window."""
    import numpy as np

    sizes = [k for k, _, _ in D.item_windows("1", " ".join(f"w{i}" for i in range(30)))]
    rows = D.item_windows("1", " ".join(f"w{i}" for i in range(30)))
    table = D.Patterns(np.array([r[1] for r in rows], np.uint64), [r[2] for r in rows], ["1"] * len(rows))
    assert sizes == [13] * 18 and (table.shift == 12).mean() > 0.99
