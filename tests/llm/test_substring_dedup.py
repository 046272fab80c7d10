import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, strategies as st

from tidemark.llm import blocks as B, substring_dedup as S, textops as X


def brute(docs, size):
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    seen, out = set(), []
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if key in seen:
                gone.update(range(i, i + size))
            seen.add(key)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def texts(seed, n, words="a b c dé e f".split(" ")):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def test_matches_brute_force(spark, frame):
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts(1, 60))]
    rows += [(None, "a b c a b c a b c"), (200, None), (201, ""), (202, " \t\n "), (5, rows[0][1]), (3, rows[0][1]), (3, rows[0][1])]
    rows += [(300, "x y z " * 4000), (301, "\x0bx\x0cy\rz x y z\x1cq")]
    for size in (3, 20):
        got = S.removed(frame(rows), size=size, block_bytes=400, digest=True)
        assert order((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == order(brute(rows, size))


def test_spans_and_text(frame):
    rows = [(1, "p q r s t"), (2, "x q r s t y p q"), (3, "q r s")]
    got = {r.doc_id: r for r in S.removed(frame(rows), size=3).collect()}
    assert got[1].spans == [] and got[1].kept_text == "p q r s t"
    assert [tuple(s) for s in got[2].spans] == [(1, 5)] and got[2].kept_text == "x y p q"
    assert [tuple(s) for s in got[3].spans] == [(0, 3)] and got[3].kept_text == ""


def test_empty_table(frame):
    assert S.removed(frame([])).count() == 0


@given(st.lists(st.text(alphabet="ab é\t\n", max_size=30), max_size=6))
def test_word_spans(texts_):
    import pyarrow as pa

    data, bounds = X.text_bytes(pa.array(texts_, pa.string()))
    starts, ends, edges = X.word_spans(data, bounds, X.NOT_SPACE)
    got = [[data[a:b].tobytes().decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(edges[:-1], edges[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts_]
    out, at = X.joined_words(data, bounds, starts, ends, np.ones(len(starts), bool))
    assert [out[a : max(a, b - 1)].tobytes().decode() for a, b in zip(at[:-1], at[1:])] == [" ".join(w) for w in got]


def test_equal_words_hash_alike_whatever_the_run(monkeypatch):
    import pyarrow as pa

    text = " ".join(["ab", "cdé", "x" * 50] * 40)
    data, bounds = X.text_bytes(pa.array([text]))
    starts, ends, _ = X.word_spans(data, bounds, X.NOT_SPACE)
    whole = X.word_hashes(data, starts, ends)
    monkeypatch.setattr(X, "HASH_BYTES", 64)
    assert (X.word_hashes(data, starts, ends) == whole).all() and len(set(whole.tolist())) == 3


@pytest.mark.parametrize("kind", [np.uint32, np.int64, np.float32])
def test_squeeze(kind):
    values = np.arange(1000).astype(kind)
    assert (B.unsqueeze(B.squeeze(values), kind) == values).all()
    assert len(B.unsqueeze(B.squeeze(values[:0]), kind)) == 0
