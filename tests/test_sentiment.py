"""Lexicon scoring against a direct, word-by-word computation."""

import math
import random
from datetime import datetime

import pytest

from tidemark.functions import lexicon_rules as R
from tidemark.operators import sentiment as S

LEX = {"good": 1.9, "bad": -2.5, "great": 3.1, "awful": -2.0, ":)": 2.0, "never": -0.3, "crash": -1.7}
NOW = datetime(2024, 1, 10)


PH = R.Phrases()


def brute(title, body, LEX=LEX):  # noqa: N803
    text = (f"{title or ''}\n\n{body or ''}").strip()
    words = []
    for t in text.split():
        bare = t.strip(R.PUNCTUATION)
        words.append(bare if len(bare) > 2 else t)
    mixed = 0 < sum(w.isupper() for w in words) < len(words)
    lowered = [w.lower() for w in words]
    but = lowered.index("but") if "but" in lowered else None
    values = []
    for i, w in enumerate(words):
        v = LEX.get(lowered[i])
        at = lambda k: lowered[k] if 0 <= k < len(words) else ""
        if v is None or lowered[i] in R.BOOSTERS or (lowered[i], at(i + 1)) == PH.kind:
            values.append(0.0)
            continue
        if lowered[i] == "no" and at(i + 1) in LEX:
            v = 0.0
        if at(i - 1) == "no" or at(i - 2) == "no" or (at(i - 3) == "no" and at(i - 1) in ("or", "nor")):
            v = LEX[lowered[i]] * R.NEGATION_FACTOR
        sign = lambda x: (x > 0) - (x < 0)
        if mixed and w.isupper():
            v += sign(v) * R.CAPS_BOOST
        for d in (1, 2, 3):
            if i - d < 0:
                continue
            p, word = lowered[i - d], words[i - d]
            if p in LEX:
                continue
            if p in R.BOOSTERS:
                push = R.BOOSTERS[p] + (R.CAPS_BOOST if mixed and word.isupper() else 0)
                v += sign(v) * push * R.BOOSTER_DAMPING[d - 1]
            after = [at(i - k) for k in range(1, d)]
            if p == "never" and {"so", "this"} & set(after):
                v *= R.NEVER_FACTOR
            elif p == "without" and "doubt" in after:
                pass
            elif p in R.NEGATIONS or "n't" in p:
                v *= R.NEGATION_FACTOR
            if d == 3:
                say = lambda *k: " ".join(at(i + x) for x in k)
                back = [say(-1, 0), say(-2, -1, 0), say(-2, -1), say(-3, -2, -1), say(-3, -2)]
                v = next((PH.idioms[x] for x in back if x in PH.idioms), v)
                for x in (say(0, 1), say(0, 1, 2)):
                    v = PH.idioms.get(x, v)
                v += sum(PH.boosters.get(x, 0) for x in (back[3], back[4], back[2]))
        if at(i - 1) == "least" and "least" not in LEX and at(i - 2) not in ("at", "very"):
            v *= R.NEGATION_FACTOR
        values.append(v)
    if but is not None:
        values = [v * (0.5 if i < but else 1.5 if i > but else 1) for i, v in enumerate(values)]
    q = text.count("?")
    emphasis = min(text.count("!"), 4) * 0.292 + (0 if q <= 1 else q * 0.18 if q <= 3 else 0.96)
    total = sum(values)
    total += ((total > 0) - (total < 0)) * emphasis
    up, down = sum(v + 1 for v in values if v > 0), sum(1 - v for v in values if v < 0)
    plain = sum(v == 0 for v in values)
    if up > down:
        up += emphasis
    elif down > up:
        down += emphasis
    mass = up + down + plain
    shares = [x / mass if mass else 0.0 for x in (up, plain, down)]
    return (total / math.sqrt(total * total + 15), *shares, len(text))


def score(spark, posts, LEX=LEX, **kw):  # noqa: N803
    df = spark.createDataFrame(
        [(str(i), "f", t, b, NOW) for i, (t, b) in enumerate(posts)],
        "id STRING, subreddit STRING, title STRING, selftext STRING, created_utc TIMESTAMP",
    )
    lexicon = spark.createDataFrame(list(LEX.items()), "word STRING, valence DOUBLE")
    return {int(r.post_id): r for r in S.score_posts(df, lexicon, **kw).collect()}


def check(spark, posts, lexicon=LEX):
    out = score(spark, posts, lexicon)
    assert set(out) == set(range(len(posts)))
    for i, (t, b) in enumerate(posts):
        compound, pos, neu, neg, length = brute(t, b, lexicon)
        r = out[i]
        assert (r.compound, r.pos, r.neu, r.neg) == pytest.approx((compound, pos, neu, neg), abs=6e-4), (t, b)
        assert r.text_length == length


def test_rules_one_by_one(spark):
    check(
        spark,
        [
            ("good", ""),
            ("not good", "at all"),
            ("GOOD day", "very GOOD"),
            ("VERY good", "and bad"),
            ("GOOD BAD", ""),
            ("never good", "don't crash"),
            ("good but awful", "(but) great"),
            ("bad!!!!!!", "what??? ?"),
            ("great!", "really?? great"),
            ("", ""),
            (None, None),
            ("  ", "\n"),
            ("extremely extremely extremely bad", "barely good"),
            (":) fine", "--good--, 'bad'"),
            ("plain words only", "nothing here"),
            ("rebut butter", "x but-y good"),
        ],
    )


PHRASED = {"good": 1.9, "bad": -2.5, "great": 3.1, "no": -1.2, "kind": 2.4, "bomb": -2.2, "death": -2.9, "doubt": -1.5, "kiss": 1.8, "broken": -2.1, "heart": 3.2}


def test_phrases_one_by_one(spark):
    posts = [
        "least good", "at least good", "very least good", "the least bad day", "never so good", "never this very good", "it was never so very good",
        "never good", "without doubt good", "without a doubt good", "without good", "no good", "no bad no", "no day good", "no x or good", "no x y good",
        "kind of good", "a kind man", "it was a kind of good", "it was sort of good", "they say it is just enough good", "that is the bomb now",
        "here is the kiss of death", "here is a kiss of death", "my own broken heart", "all over my broken heart aches", "one two three bad ass boy",
        "yeah right that is good", "this is good to die for", "NO GOOD day", "least", "no", "kind of",
    ]
    check(spark, [(p, "") for p in posts] + [("", p) for p in posts], PHRASED)
    rules = {(t, brute(t, "", PHRASED)[0]) for t in ("never so good", "never good")}
    assert {c > 0 for t, c in rules if "so" in t} == {True} and {c < 0 for t, c in rules if "so" not in t} == {True}


def test_random_phrases(spark):
    rng = random.Random(8)
    pool = list(PHRASED) * 2 + ["least", "at", "never", "so", "this", "without", "or", "of", "sort", "just", "enough", "the", "to", "die", "for", "x", "NO", "Kind", "not", "very"]
    check(spark, [(" ".join(rng.choices(pool, k=rng.randint(0, 5))), " ".join(rng.choices(pool, k=rng.randint(0, 40)))) for _ in range(200)], PHRASED)


def test_random_texts(spark):
    rng = random.Random(5)
    pool = list(LEX) + ["very", "not", "but", "market", "VERY", "GOOD", "isn't", "a", "I", "kinda", "never", "x!", "why?", "…", "é É"]
    posts = [
        (" ".join(rng.choices(pool, k=rng.randint(0, 4))), rng.choice([" ", "\n", "  "]).join(rng.choices(pool, k=rng.randint(0, 40))))
        for _ in range(150)
    ]
    check(spark, posts)


def test_whole_text_counts_unless_limited(spark):
    body = "word " * 5000 + "good"
    assert score(spark, [("t", body)])[0].compound > 0
    assert score(spark, [("t", body)], body_chars=4000)[0].compound == 0


def test_large_lexicon_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "MAX_BROADCAST_WORDS", 3)
    check(spark, [("good", "not bad"), ("", "")])


def test_labels_at_the_cuts(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,), (-0.0499,)], "c DOUBLE")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(S.label(F.col("c"))).collect()] == ["positive", "negative", "neutral", "neutral"]


def test_only_unscored_recent_posts(spark):
    posts = spark.createDataFrame(
        [("1", NOW), ("2", NOW), ("3", datetime(2023, 1, 1))], "id STRING, created_utc TIMESTAMP"
    ).selectExpr("id", "'f' AS subreddit", "'t' AS title", "CAST(NULL AS STRING) AS selftext", "created_utc")
    scored = spark.createDataFrame([("1",)], "post_id STRING")
    assert [r.id for r in S.posts_to_score(posts, scored, as_of=NOW).collect()] == ["2"]
    assert S.posts_to_score(posts, None, as_of=NOW).count() == 2


def test_batches_and_token_join_agree(spark, monkeypatch):
    """Tokens go through no wide row each: a small lexicon is met in batches, with the results of the join."""
    rng = random.Random(11)
    pool = [*PHRASED, "least", "at", "never", "so", "without", "or", "of", "sort", "just", "enough", "the", "bad ass", "yeah right", "NO", "very", "VERY",
            "but", "isn't", "(good)", "x!", "why?", "É", "Éß", "\x1f", " ", "\x85", "a.", "'", "ǅ", "ªB", "KIND,", "der"]
    text = lambda n: rng.choice([" ", "\n", "　 "]).join(rng.choices(pool, k=rng.randint(0, n)))
    posts = [(text(4), text(40)) for _ in range(150)] + [(None, None), ("", "  "), ("good", None)]
    monkeypatch.setattr(S.lexicon_batch, "CHUNK_CHARS", 200)
    lexicon = PHRASED | {"very": 0.4, "": 1.0, "enough": None}
    batched = score(spark, posts, lexicon)
    monkeypatch.setattr(S, "MAX_BROADCAST_WORDS", 0)
    assert batched == score(spark, posts, lexicon)


def test_small_lexicon_makes_no_row_per_token(spark):
    df = spark.createDataFrame([("1", "f", "good day", "", NOW)], "id STRING, subreddit STRING, title STRING, selftext STRING, created_utc TIMESTAMP")
    plan = S.score_posts(df, spark.createDataFrame([("good", 1.0)], "word STRING, valence DOUBLE"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_term_pattern_finds_whole_words(spark):
    """Words first, edges after: the same texts as with the edges spelled out around the words."""
    import re

    from tidemark.functions.terms import NOT_WORD_CHAR, word_pattern

    rng = random.Random(2)
    words = ("this", "is", "très", "a.b")
    plain = rf"(?i)(^|{NOT_WORD_CHAR})({'|'.join(map(re.escape, words))})($|{NOT_WORD_CHAR})"
    pool = ["this", "THIS", "is", "thisis", "isthis", "_is", "is_", "é", "TRès", "TRÈS", "a.b", "axb", "a.B9", " ", " ", "\n", ".", "-", ""]
    texts = [("".join(rng.choices(pool, k=rng.randint(0, 4))),) for _ in range(400)]
    df = spark.createDataFrame(texts, "t STRING")
    rows = df.select("t", df.t.rlike(plain).alias("want"), df.t.rlike(word_pattern(words)).alias("got")).collect()
    assert all(r.want == r.got for r in rows) and len({r.want for r in rows}) == 2


def test_views_share_one_scoring(spark, sf_dir):
    from tidemark.plans import catalog

    frames = catalog.Frames(spark, sf_dir)
    catalog.REGISTRY["view_row_counts"](frames)
    assert "scored" in vars(frames) and "documents.parquet" not in " ".join(frames.stored_scores.inputFiles())
    assert set(frames.stored_scores.inputFiles()) <= set(frames.v_sentiment.inputFiles())


def test_only_words_that_rules_name_are_worked_out(spark):
    import pyarrow as pa

    from tidemark.operators import lexicon_batch as B

    rules = B.Rules({"good": 1.9, "σας": 1.0, "i̇s": 2.0}, ["not"], ["very"], {"very": 0.293}, PH)
    named = pa.array(sorted(rules.named()), pa.string())
    tokens = pa.array([f"w{i}" for i in range(5000)] + ["Good!", "(VERY", "wouldn't", "ΣΑΣ", "İs", "größe", "12.5"])
    words = B.Words(tokens, rules, named)
    assert set(words.number) == {"", B.OTHER, "good", "very", "wouldn't", "σας", "i̇s"}
    assert words.low[:5000].tolist() == [1] * 5000 and not words.entry[1] and not words.negates[1]
    assert [bool(words.entry[i]) for i in words.low[-7:]] == [True, False, False, True, True, False, False]
    assert words.upper[-7:].tolist() == [False, True, False, True, False, False, False]


def test_flags_equal_their_patterns_after_a_cheaper_test(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.terms import mention_flags, word_pattern

    terms = {"A": ("this", "is"), "B": ("très",), "C": ("C++",), "D": ("link",), "E": ("ΣΑΣ", "der")}
    texts = [
        "this", "THIS.", "thistle", "xThis", "İthis", "i̇this", "linK", "linK LINK", "under der", "DER", "TRèS", "TRÈS", "c++", "xc++",
        "C++x", "ΣΑΣ", "ΣΑΣ'Α", "σας", "", None, "is_", "_is", "1is", "is1", "Iś", "unders, der",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    want = [F.col("t").rlike(word_pattern(w)).alias(f"want_{k.lower()}") for k, w in terms.items()]
    flagged = df.select("t", *want, *mention_flags(F.col("t"), terms))
    rows = flagged.collect()
    assert [[r[f"want_{k}"] for k in "abcde"] for r in rows] == [[r[f"mentions_{k}"] for k in "abcde"] for r in rows]
    assert {r.t for r in rows if r.mentions_e} >= {"ΣΑΣ", "ΣΑΣ'Α", "DER", "under der"}
    plan = df.select(*mention_flags(F.col("t"), terms))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(lower(t" in plan
