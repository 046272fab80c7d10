import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import blocks as B, langid, ngrams as N, suffix_tree as S


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


class Tree:
    """A probabilistic suffix tree built context by context."""

    def __init__(self, texts, order, divergence, smooth):
        self.smooth = smooth
        self.counts = defaultdict(Counter)
        for t in texts:
            data = b"\n" * order + (" ".join(words(t)) + "\n").encode()
            for i in range(order, len(data)):
                for k in range(order + 1):
                    self.counts[data[i - k : i]][data[i]] += 1
        known = {c for c, n in self.counts.items() if len(c) < 2 or sum(n.values()) >= 2}
        self.counts = {c: n for c, n in self.counts.items() if c in known}
        self.kept = {c for c in known if len(c) < 2} | {b""}
        for c in known:
            n = sum(self.counts[c].values())
            gain = sum(x / n * math.log2(x / n / self.p(c[1:], s)) for s, x in self.counts[c].items()) if c else 0
            if gain >= divergence:
                self.kept.update(c[i:] for i in range(len(c) + 1))

    def p(self, c, s):
        n = self.counts[c]
        below = self.p(c[1:], s) if c else 1 / 256
        return (n[s] + self.smooth * below) / (sum(n.values()) + self.smooth)

    def score(self, text, order):
        data, total = b"\n" * order + (" ".join(words(text)) + "\n").encode(), 0.0
        for i in range(order, len(data)):
            k = next(k for k in range(order, -1, -1) if data[i - k : i] in self.kept)
            total += math.log10(self.p(data[i - k : i], data[i]))
        return total


ROWS = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The dog sat", "a cat and a dog", "", "été là", "the the the", "mat dog cat sat"] * 3)]
EXTRA = [(50, None), (51, "unseen wörds here"), (None, "the cat"), (3, "the cat"), (3, "the cat"), (60, "cat\tdog\x0bsat " * 2000)]


@pytest.mark.parametrize("order,salted", [(3, False), (S.ORDER, False), (S.ORDER, True)])
def test_matches_brute_force(spark, frame, monkeypatch, order, salted):
    """Also as the query runs it, and with shards that are copied for every two blocks."""
    if salted:
        monkeypatch.setattr(S, "SALT_BLOCKS", 2)
        monkeypatch.setattr(S.B, "BLOCK_BYTES", 4096)
        monkeypatch.setattr(S.B.pack_by_arrival, "__defaults__", (4096,))
    rows = ROWS + EXTRA
    out = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    train = [t for i, t in rows if not out[i]]
    docs = frame(rows)
    held = langid.held_out("doc_id", 7)
    given = dict(order=3, divergence=0.3, smooth=2.0) if order == 3 else {}
    model = S.learn(docs.where(~held), **given)
    tree = Tree(train, order, given.get("divergence", S.DIVERGENCE), given.get("smooth", S.SMOOTH))
    counts = Counter(w for t in train for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((str(i), len(tokens), sum(counts[w] > 0 for w in tokens), base, tree.score(t, order)))
    found = S.score(docs, model, held_out=held).collect()
    assert all((r.train_tokens, r.held_out) == (n, out[r.doc_id]) for r in found)
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in found]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=1e-5)


def test_next_byte_probabilities_sum_to_one(frame):
    model = S.learn(frame(ROWS), order=3, divergence=0.3)
    parts = [(B.unsqueeze(r["keys"], np.uint64), B.unsqueeze(r["counts"], np.int64)) for r in model.counted.collect()]
    key, count = N.summed(*(np.concatenate(x) for x in zip(*parts)))
    for context in (b"the", b"cat", b"zzz", b"\n\n\n", b"s q"):
        low = sum(c << (8 * (len(context) - 1 - k)) for k, c in enumerate(reversed(context)))
        asked = np.array([(s << 24) + low for s in range(256)], np.uint64)
        p = S.shard_log10(asked, key, count, model.low, 3, S.LEAST, 0.3, S.SMOOTH)
        assert math.isclose((10.0**p).sum(), 1, rel_tol=1e-9)


def test_more_text_gives_more_contexts(spark, sf_dir):
    """Nothing is cut by its share of the corpus: rare contexts of a small text stay when much other text is added."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL")
    rare = "zq xw zq xw jk zq"
    one = spark.createDataFrame([(-1, rare), (-2, rare)], "doc_id long, text string")
    probe = spark.createDataFrame([(-3, rare)], "doc_id long, text string")
    alone = S.score(probe, S.learn(docs.select("doc_id", "text"))).first().score
    added = S.score(probe, S.learn(docs.select("doc_id", "text").unionByName(one))).first().score
    assert added > alone + 10


def test_empty(frame):
    model = S.learn(frame([]))
    assert S.score(frame([]), model).count() == 0
    (row,) = S.score(frame([(1, None)]), model).collect()
    assert (row.n_tokens, row.train_tokens) == (1, 1)


@pytest.mark.parametrize("size", [1, 3, 64, 1000])
def test_keys_in_pieces(size):
    """Pieces that cut rows, also shorter than a context, give the keys of whole rows."""
    texts = [t or "" for _, t in ROWS + EXTRA[:3]]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    whole = N.keys(data, bounds, S.ORDER)
    parts = list(N.pieces(data, bounds, S.ORDER, size))
    assert all(len(key) == b - a <= size for a, b, key in parts)
    assert np.array_equal(np.concatenate([key for _, _, key in parts]), whole)
    assert np.array_equal(N.distinct(data, bounds, S.ORDER, size), np.unique(whole))
    assert not len(N.distinct(data[:0], np.zeros(1, np.int64), S.ORDER))


def test_memory_of_a_long_text():
    """A block's distinct grams take a few bytes for each byte of it, not several keys."""
    text = np.frombuffer(b"the cat sat on the mat and the dog sat too " * 200_000, np.uint8)
    S.stream(text[:1000], np.array([0, 1000]))
    tracemalloc.start()
    N.distinct(*S.stream(text, np.array([0, len(text)])), S.ORDER)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * len(text)


@pytest.mark.parametrize("held", [10, N.HELD_KEYS])
def test_counts_by_shard(frame, monkeypatch, held):
    """Each shard has its own grams in order with their sums, however often a task sends what it holds."""
    monkeypatch.setattr(N, "HELD_KEYS", held)
    texts = [t for _, t in ROWS if t]
    key = np.concatenate([N.keys(d, np.array([0, len(d)]), 3) for d in (np.frombuffer(t.encode(), np.uint8) for t in texts)])
    docs = frame([(i, t) for i, t in enumerate(texts)]).repartition(3)
    want = dict(zip(*(x.tolist() for x in np.unique(key, return_counts=True))))
    got = {}
    for r in N.counts(docs, "lang", "text", 3, 5).collect():
        own, count = B.unsqueeze(r["keys"], np.uint64), B.unsqueeze(r["counts"], np.int64)
        assert (np.diff(own.astype(np.int64)) > 0).all() and set(N.shard_of(own, 3, 5)) == {r.shard}
        got |= dict(zip(own.tolist(), count.tolist()))
    assert got == want
