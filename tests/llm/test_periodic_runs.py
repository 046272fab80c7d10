import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import periodic_runs as R


def brute(words, least=6, exponent=4):
    """All runs by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plant(doc, text):
    h = zlib.crc32(str(doc).encode())
    words = split(text)
    if doc is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def check(ids, bounds, least=6, exponent=4):
    start, end, q = R.slice_runs(np.array(ids, np.int64), np.array(bounds), least, exponent)
    want = [(a + s, a + s + n, p) for a, b in zip(bounds, bounds[1:]) for s, n, p in brute(ids[a:b], least, exponent)]
    assert list(zip(start.tolist(), end.tolist(), q.tolist())) == want


@pytest.mark.parametrize("letters", [1, 2, 3, 5, 50])
def test_random_sequences(letters):
    rng = random.Random(letters)
    for trial in range(60):
        ids, bounds = [], [0]
        for _ in range(rng.randrange(1, 6)):
            for _ in range(rng.randrange(8)):
                unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
                ids += (unit * rng.randrange(1, 9))[: rng.randrange(1, 60)]
            bounds.append(len(ids))
        check(ids, bounds)
        check(ids, bounds, 2, 5)


def test_structured_sequences():
    fib, a = [0], [0, 1]
    while len(a) < 600:
        fib, a = a, a + fib
    check(a, [0, len(a)])
    thue = [bin(i).count("1") % 2 for i in range(5000)]
    check(thue, [0, len(thue)], 6, 4)
    check([7] * 3000, [0, 1000, 1000, 3000])
    check([0, 1] * 700 + [0] + [0, 1] * 9, [0, 1419])
    ramp = [x for k in range(40, 0, -1) for x in range(k)]  # prefixes of one text
    check(ramp, [0, len(ramp)])
    nested = ([0, 0, 0, 0, 0, 0, 1] * 6 + [2]) * 5
    check(nested, [0, len(nested)])


def test_grammar_replays_every_occurrence():
    rng = random.Random(3)
    ids = np.array([rng.randrange(4) for _ in range(2000)], np.int64)
    places = 0
    for rule, lo, mid, hi in R.grammar(ids, np.array([0, 900, 2000])):
        assert ((lo < mid) & (mid < hi)).all() and not ((lo < 900) & (hi > 900)).any()
        seen = {}
        for r, a, m, b in zip(rule.tolist(), lo.tolist(), mid.tolist(), hi.tolist()):
            assert seen.setdefault(r, (ids[a:b].tolist(), m - a)) == (ids[a:b].tolist(), m - a)
        places += len(rule)
    assert places == 1998  # one symbol is left of each document


ROWS = [
    (1, "a a a a a a b"), (2, None), (3, ""), (4, " \t\n"), (5, "x y x y x y x y x\u00a0y"), (6, "a b " * 4), (7, "été là " * 9 + "fin"),
    (None, "c " * 20), (8, "A a " * 10), (8, "A a " * 10), (9, "no run here"), (10, "q\x0bq\x0cq\rq q q q"),
]


def test_documents_by_brute_force(frame):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = ROWS + [(100 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 120)))) for i in range(150)]
    rows += [(500, "long text " * 60_000), (501, " ".join(f"v{i % 7919}" for i in range(40_000)))]
    got = R.digest(R.detect(R.planted(frame(rows))))
    want = []
    for doc, text in rows:
        words = plant(doc, text)
        runs = brute(words) if doc not in (500, 501) else {500: [(0, len(words), 2)], 501: [(0, 40_000, 7919)]}[doc]
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, runs))]
        want.append((doc, len(runs), *top, top[1] and 1000 * top[1] // top[2], *sha))
    assert zlib.crc32(b"500") % 10 and zlib.crc32(b"501") % 10 and any(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_collapsed_text(frame):
    got = {r.doc_id: (r.n_words, r.collapsed) for r in R.detect(frame(ROWS[:7])).collect()}
    assert got[1] == (7, "a b") and got[2] == got[3] == got[4] == (0, "") and got[5][1] == "x y x\u00a0y"
    assert got[6] == (8, "a b") and got[7] == (19, "été là fin")


def test_empty_and_refused(frame):
    assert R.digest(R.detect(R.planted(frame([])))).count() == 0
    with pytest.raises(ValueError):
        R.slice_runs(np.zeros(5, np.int64), np.array([0, 5]), 6, 3)
