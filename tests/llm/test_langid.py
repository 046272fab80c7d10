import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tidemark.llm import langid as L, ngrams as N
from tidemark.llm.backoff import KeyIndex


def brute_bits(train, text, order):
    """Code length under a PPM tree built byte by byte."""
    tree = defaultdict(Counter)
    for t in train:
        data = b"\n" * order + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                tree[data[i - k : i]][data[i]] += 1
    tree = {c: n for c, n in tree.items() if len(c) < 2 or sum(n.values()) >= 2}
    data, bits = b"\n" * order + text.encode(), 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = tree.get(data[i - k : i])
            if not seen:
                continue
            n, t = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / (n + t))
                break
            bits -= math.log2(t / (n + t))
        else:
            bits += 8
    return bits


def make(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def test_code_lengths_match_brute_force(spark, frame):
    rng = random.Random(1)
    train = {"aa": [make(rng, "abcé", 30) for _ in range(6)], "bb": [make(rng, "cdeß", 30) for _ in range(6)]}
    rows = [(i, t, lang) for lang, ts in train.items() for i, t in enumerate(ts)] + [(90, None, "aa"), (91, "zzz", None)]
    model = L.learn(frame(rows), order=3)
    assert model.languages == ["aa", "bb"]
    texts = ["abc éa", "", "cde ß", "qqq 123", "a" * 3000] + train["aa"]
    bits, _ = L.code_lengths(model, pa.array(texts))
    for t, row in zip(texts, bits):
        for i, lang in enumerate(model.languages):
            assert math.isclose(row[i], brute_bits(train[lang], t, 3), rel_tol=1e-5, abs_tol=1e-4)


def test_predictions(spark, frame):
    rng = random.Random(2)
    rows = [(i, make(rng, "abc", 20), "aa") for i in range(20)] + [(i, make(rng, "xyz", 20), "bb") for i in range(20, 40)]
    model = L.learn(frame(rows))
    asked = [(1, "abc cab"), (2, "zyx xy"), (3, None), (4, ""), (5, "12 34 !!"), (6, "²½"), (None, "xyz"), (2, "abc"), (2, "abc")]
    got = sorted(map(str, ((r.doc_id, r.lang_pred) for r in L.identify(frame(asked), model).collect())))
    want = [(1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (6, "und"), (None, "bb"), (2, "aa"), (2, "aa")]
    assert got == sorted(map(str, want))
    assert all(0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0) for r in L.identify(frame(asked), model).collect())
    kept = L.drop_unidentified(frame(asked), model)
    assert kept.columns == frame(asked).columns and kept.count() == 5


def test_nothing_learned_and_empty(frame):
    model = L.learn(frame([(1, "abc", None), (2, None, "en")]))
    (row,) = L.identify(frame([(1, "abc")]), model).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert L.identify(frame([]), model).count() == 0


def test_sample_is_bounded_and_takes_copies_once(frame):
    rng = random.Random(5)
    rows = [(i, make(rng, "abc", 9), "aa") for i in range(300)] + [(i, "one copy", "aa") for i in range(300)] + [(i, "bb bb", "bb") for i in range(50)]
    got = [(r.lang, r.text) for r in L.sample(frame(rows), "text", "lang", 40).collect()]
    assert len(got) == len(set(got)) == 41 and sum(lang == "aa" for lang, _ in got) == 40
    assert L.sample(frame(rows), "text", "lang", 1000).count() == len({(r[2], r[1]) for r in rows})


def test_held_out_accuracy(spark, sf_dir):
    from tidemark.llm import queries

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries.op5_language_id(spark, sf_dir).join(docs, "doc_id").where("held_out AND lang_pred != 'und'").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows) > 0


def test_key_index():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**50, 5000, dtype=np.int64).astype(np.uint64))
    index = KeyIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    absent = np.setdiff1d(rng.integers(0, 2**50, 5000, dtype=np.int64).astype(np.uint64), keys)
    assert (index.find(absent) == -1).all() and len(KeyIndex(keys[:0]).find(absent)) == len(absent)


def test_gram_counts(frame):
    got = Counter()
    for r in N.counts(frame([(1, "abab", "x"), (2, None, "x"), (3, "ab", "y")]), "lang", "text", 2, 3).collect():
        from tidemark.llm import blocks as B

        for k, c in zip(B.unsqueeze(bytes(r["keys"]), np.uint64).tolist(), B.unsqueeze(bytes(r.counts), np.int64).tolist()):
            got[r.grp, k.to_bytes(3, "big")] += c
    assert got == {("x", b"a\n\n"): 1, ("x", b"ba\n"): 1, ("x", b"aba"): 1, ("x", b"bab"): 1, ("y", b"a\n\n"): 1, ("y", b"ba\n"): 1}
