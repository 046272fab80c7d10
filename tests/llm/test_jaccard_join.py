import random
import re

import numpy as np
import pytest

from tidemark.llm import jaccard_join as J
from tidemark.llm.components import components


def shingles(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    out = []
    for a, (doc, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if root(b) == root(a) and rows[b][0] is not None]
        out.append((doc, len(sets[a]), min(ids) if ids else None))
    return out


def near(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    shared = [f"s{i}" for i in range(30)]
    for _ in range(8):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([9, 40, 120]))] + (shared if rng.random() < 0.5 else [])
        rows += [near(rng, base, rng.randrange(0, 4)) for _ in range(7)]
    # a chain: neighbours are linked, ends are not
    long = [f"c{i}" for i in range(300)]
    rows += [" ".join(long[4 * k : 4 * k + 240]) for k in range(12)]
    rows += [None, "", " \n", "One", "one", "two words", "two  WORDS", "a b c", "a b c", "a b c a b c", "x " * 5000]
    ids = rng.sample(range(1000), len(rows))
    rows = list(zip(ids, rows))
    return rows + [(None, rows[0][1]), (None, "null alone here"), (None, "null alone here"), (rows[3][0], rows[9][1]), rows[5]]


def test_matches_brute_force(spark, frame):
    rows = corpus(1)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.join(frame(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_large_clusters_are_cut(spark, frame, monkeypatch):
    monkeypatch.setattr(J, "CLUSTER_SHINGLES", 700)
    monkeypatch.setattr(J, "SHARD_TOKENS", 200)
    rows = corpus(2)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.join(frame(rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_one_row_of_each_component_stays(spark, frame):
    rows = corpus(3)
    kept = J.keep_first(frame(rows))
    assert kept.columns == frame(rows).columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    groups = {}
    for (doc, t), (_, n, c) in zip(rows, brute(rows)):
        if n:
            groups.setdefault(("id", c) if c is not None else ("set", frozenset(shingles(t))), []).append((doc, t))
    assert len(got) == len(groups) + sum(not shingles(t) for _, t in rows)
    for key, members in groups.items():
        mine = [g for g in got if g in members]
        assert key[0] == "set" or any(g[0] == key[1] for g in mine)


def test_empty_table(frame):
    assert J.join(frame([])).count() == 0 and J.keep_first(frame([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_search_spans_components(seed):
    rng = np.random.default_rng(seed)
    base = rng.choice(10**6, 80, replace=False)
    sets = []
    for _ in range(120):
        s = base.copy()
        s[rng.integers(0, 80, rng.integers(0, 9))] = rng.integers(10**6, 10**7, 1)
        sets.append(np.unique(s).astype(np.uint64))
    sets = list({s.tobytes(): s for s in sets}.values())

    def classes(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            old, new = label[a], label[b]
            label = [new if x == old else x for x in label]
        groups = {}
        for i, x in enumerate(label):
            groups.setdefault(x, set()).add(i)
        return sorted(map(sorted, groups.values()))

    every = [(a, b) for a in range(len(sets)) for b in range(a)
             if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))]
    found = J.search(sets)
    assert classes(found) == classes(every) and len(found) < len(sets)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (100, 102), (7, 7), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(41)}) == 1 and got[101] == got[102] == got[100] != got[0]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
