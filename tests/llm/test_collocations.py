import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import blocks as B, collocations as C


def grams(rows, longest=3):
    f, n = Counter(), Counter()
    for _, text, *lang in rows:
        lang = (lang or ["en"])[0] or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, longest=3, least=10, percent=50, top=2000):
    f, n = grams(rows, longest)
    often = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    longer = defaultdict(int)
    for (lang, w), c in often.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longer[lang, w[i : i + k]] = max(longer[lang, w[i : i + k]], c)
    out = defaultdict(list)
    for (lang, w), a in often.items():
        if longer[lang, w] and 100 * longer[lang, w] >= percent * a:
            continue
        cuts = [(f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])
    )


def shown(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(seed=4, rows=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["été", "Ünd", "x" * 300, "'", "😀"]
    fixed = ["new york city", "alpha Beta gamma delta", "of the", "la la la la"]
    text = lambda: " ".join(rng.choice(vocabulary[: rng.choice([8, 65])]) if rng.random() < 0.8 else rng.choice(fixed) + rng.choice([".", ",", "", " ;", "\n"]) for _ in range(rng.randrange(60)))
    out = [(i, text(), rng.choice(["en", "en", "de", None, "und"])) for i in range(rows)]
    copy = text() + " " + " ".join(fixed)
    return out + [(rows + i, copy, "en") for i in range(rows // 2)] + [(1, None, "en"), (None, "", "de"), (2, " \t.\x0b", None), (3, "rare lang " * 12, "zz")]


@pytest.mark.parametrize("cycle,bits", [(1, None), (3, 3)])
def test_matches_brute_force(frame, cycle, bits):
    """Also with eight slots for all phrases, where nearly every phrase is active at some step."""
    rows = corpus()
    assert shown(C.mine(frame(rows).repartition(5), cycle=cycle, bits=bits)) == brute(rows)


def test_longer_phrases_and_short_reports(frame):
    rows = corpus(9, 150)
    got = C.mine(frame(rows), longest=4, least=5, percent=70, top=7, cycle=2)
    assert shown(got) == brute(rows, 4, 5, 70, 7)


def test_counts_cover_every_shard_once(frame):
    rows = corpus(2, 100)
    found, n = C.count(frame(rows).repartition(3), least=3, cycle=3)
    f, words = grams(rows)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found.collect()} == {p: c for p, c in f.items() if c >= 3}
    assert {r.lang: r.n for r in n.collect()} == {k: v for k, v in words.items() if v}


def test_lengths_interleave():
    """Phrases start before all words are counted, and are counted for a whole cycle."""
    steps = C.Steps(12, 3)
    assert steps.active(1, 2, 3) and not steps.active(1, 3, 3) and not steps.active(2, 1, 3)
    steps.at[1][7] = 0
    assert [steps.active(2, t, 3) for t in range(6)] == [False, True, True, True, False, False]
    steps.at[2][9] = 2
    assert [steps.active(3, t, 3) for t in range(8)] == [False, False, False, True, True, True, False, False]


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    found = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 1)], C.FOUND)
    (row,) = C.scored(found).collect()
    assert row.score == 1_000_000 * (big - 1) ** 2 // (big * (big + 7)) == 999999


def test_hash_slots_are_spread():
    h = C._tail(np.arange(4096, dtype=np.uint64), np.arange(4096, dtype=np.uint64))
    assert len(np.unique(C.slots(h, 12))) > 2000


def test_long_text_and_empty(frame):
    rows = [(1, "one two three, " * 50_000), (2, "two three one " * 9)]
    assert shown(C.mine(frame(rows))) == brute(rows)
    assert C.mine(frame([])).count() == 0 and C.mine(frame([(1, None), (2, "")])).count() == 0


def test_hot_language_is_ranked_in_lanes(frame, monkeypatch):
    rows = corpus(6, 200)
    monkeypatch.setattr(C, "LANE", 10)
    assert shown(C.mine(frame(rows), top=5)) == brute(rows, top=5)


def test_shards_keep_and_get_open_slots_only(spark, frame):
    """What has reached the threshold is neither kept by a shard nor sent to it again; the rest is kept as sums."""
    docs = frame([(i, f"often rare{i}") for i in range(40)]).repartition(4)
    (part,) = C.dealt(docs, "lang", "text", 1, C.scratch_path(spark, "test-shards"))
    steps = C.Steps(20, 2)
    told = lambda sums: [(B.unsqueeze(r.slots, np.uint32), np.cumsum(B.unsqueeze(r.prints, np.uint64)), B.unsqueeze(r.counts, np.uint32)) for r in sums.collect()]
    first = C.summed(C.scan(part, {1}, 0, 2, steps, 1, 40), 20, 10, 40)
    ((hit, prints, counts),) = told(first)
    assert len(hit) == 1 and len(prints) == 40 and set(counts) == {1}
    steps.at[1][hit] = 0
    again = C.scan(part, {1}, 1, 2, steps, 1, 40)
    ((more, same, counts),) = told(C.summed(first.drop("slots").unionByName(again), 20, 10, 40))
    assert not len(more) and np.array_equal(same, prints) and set(counts) == {2}


def test_one_message_for_the_blocks_of_a_task(spark, frame, monkeypatch):
    """A phrase costs a task one entry, not one for each block."""
    monkeypatch.setattr(C, "SLICE", 100)
    docs = frame([(i, "a b c d e") for i in range(200)]).coalesce(1)
    (part,) = C.dealt(docs, "lang", "text", 1, C.scratch_path(spark, "test-blocks"))
    assert part.count() > 5
    rows = C.scan(part.coalesce(1), {1}, 0, 1, C.Steps(12, 2), 1, 40).collect()
    assert [B.unsqueeze(r["counts"], np.uint32).tolist() for r in rows] == [[200] * 5]
