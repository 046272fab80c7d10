"""Lexicon sentiment of posts: batches that carry the lexicon along, or a token join for a large one."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import columns as C, lexicon_rules as R
from tidemark.operators import lexicon_batch
from tidemark.session import ship_package

# Tag stored with every score. The rules are those of this module, the lexicon is the caller's.
MODEL_VERSION = "lexicon-rules-2"
LOOKBACK_DAYS = 30

# (word, valence) rows are well below 100 bytes: a lexicon that tasks carry along stays below 20 MB.
MAX_BROADCAST_WORDS = 200_000

_GAP, _TEXT = f"[{R.SPACE_CLASS}]", f"[^{R.SPACE_CLASS}]"
_MARK = "[" + re.escape(R.PUNCTUATION) + "]"
_NOT_CAPS = rf"(?:^|{_GAP})(?:[^{R.SPACE_CLASS}\p{{Lu}}]++|{_TEXT}*\p{{Ll}}{_TEXT}*)(?:{_GAP}|$)"
_BUT = rf"(?<!{_TEXT}){_MARK}*+but{_MARK}*+(?!{_TEXT})"


def label(compound: Column) -> Column:
    return (
        F.when(compound >= R.POSITIVE_FROM, "positive")
        .when(compound <= R.NEGATIVE_TO, "negative")
        .otherwise("neutral")
    )


def posts_to_score(
    posts: DataFrame,
    scored: DataFrame | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    as_of: C.AsOf = None,
) -> DataFrame:
    """Recent posts; with ``scored`` given, only those that have no score yet."""
    recent = posts.where(F.col("created_utc") >= C.ago(as_of, lookback_days, "days")).select(
        "id", "subreddit", "title", F.coalesce("selftext", F.lit("")).alias("selftext"), "created_utc"
    )
    if scored is None:
        return recent
    return recent.join(scored.select(F.col("post_id").alias("id")), "id", "left_anti")


def post_text(body_chars: int | None = None) -> Column:
    """Title, blank line, body; outer white space removed. ``body_chars`` limits the body, by default not."""
    body = F.coalesce("selftext", F.lit(""))
    if body_chars is not None:
        body = F.left(body, F.lit(body_chars))
    return F.btrim(F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), body), F.lit(R.SPACES))


def _split(text: Column) -> Column:
    return F.split(text, f"{_GAP}+")


def _bare(df: DataFrame, source: str, target: str) -> DataFrame:
    """A token without its outer punctuation, unless too little would remain (emoticons)."""
    # Own column: the trim is the dearest step per token and must not be evaluated twice.
    df = df.withColumn("_bare", F.btrim(F.col(source), F.lit(R.PUNCTUATION)))
    kept = F.when(F.length("_bare") > R.KEEP_SHORT, F.col("_bare")).otherwise(F.col(source))
    return df.withColumn(target, kept).drop("_bare")


def _is_upper(word: Column) -> Column:
    return word.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$")


def _first_but(text: Column, lowered: Column) -> Column:
    """Zero-based token index of the first "but", -1 without one."""
    # The plain substring test spares most texts the pattern.
    at = F.when(lowered.contains("but"), F.regexp_instr(lowered, F.lit(_BUT))).otherwise(0)
    return F.when(at > 0, F.size(_split(F.left(text, at - 1))) - 1).otherwise(-1)


def _emphasis(text: Column) -> Column:
    def occurrences(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    questions = occurrences("?")
    return F.least(occurrences("!"), F.lit(R.MAX_EXCLAMATIONS)) * R.EXCLAMATION + (
        F.when(questions <= 1, 0.0)
        .when(questions <= R.MAX_QUESTIONS, questions * R.QUESTION)
        .otherwise(R.MANY_QUESTIONS)
    )


def score_posts(
    posts: DataFrame,
    lexicon: DataFrame,
    negations: Collection[str] = R.NEGATIONS,
    boosters: Mapping[str, float] = R.BOOSTERS,
    body_chars: int | None = None,
    phrases: R.Phrases = R.Phrases(),
) -> DataFrame:
    """Sentiment of each post from a ``(word, valence)`` lexicon table.

    A lexicon known to be small travels with the tasks, which score posts in batches and work out what depends on a
    word alone once for each different word (:mod:`tidemark.operators.lexicon_batch`). A larger one is joined
    with the tokens. Either way one narrow row per post is left to shuffle.
    """
    lexicon = lexicon.groupBy("word").agg(F.max("valence").cast("double").alias("valence"))
    # A modifier that is itself a lexicon word keeps its valence and does not modify its neighbours.
    # The set holds at most the fixed rule words.
    rule_words = sorted({*negations, *boosters, phrases.least})
    known = lexicon.agg(
        F.count(F.lit(1)).alias("words"),
        F.collect_set(F.when(F.col("word").isin(rule_words), F.col("word"))).alias("modifiers"),
    ).first()
    negations = [w for w in negations if w not in known.modifiers]
    phrases = replace(phrases, least=None) if phrases.least in known.modifiers else phrases
    active_boosters = {w: b for w, b in boosters.items() if w not in known.modifiers}

    texts = posts.select(
        F.col("id").cast("string").alias("post_id"), "subreddit", "created_utc", post_text(body_chars).alias("text")
    )
    text = F.col("text")
    facts = texts.select(
        "post_id",
        "subreddit",
        "created_utc",
        F.length(text).alias("text_length"),
        _emphasis(text).alias("emphasis"),
        # Asked only where a word is in capitals, so some are: mixed case means some word is not.
        text.rlike(_NOT_CAPS).alias("mixed_case"),
        _first_but(text, F.lower(text)).alias("but_at"),
        "text",
    )
    if known.words <= MAX_BROADCAST_WORDS:
        valences = {r.word: r.valence for r in lexicon.collect()}
        rules = lexicon_batch.Rules(valences, negations, list(boosters), active_boosters, phrases)
        sums = _batch_sums(facts, rules)
    else:
        sums = _token_sums(facts, lexicon.withColumnRenamed("word", "entry"), boosters, active_boosters, negations, phrases)
    # Rows of one post that agree in everything are one post.
    return _finish(sums.groupBy(*_PER_POST).agg(*[F.sum(c).alias(c) for c in ("total", "up", "down", "hits")]))


_PER_POST = ("post_id", "subreddit", "created_utc", "text_length", "emphasis", "n_words")


def _batch_sums(facts: DataFrame, rules: lexicon_batch.Rules) -> DataFrame:
    ship_package(facts.sparkSession)
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in facts.schema if f.name in lexicon_batch.FACTS)
    return facts.mapInArrow(lambda batches: lexicon_batch.sums(batches, rules), f"{kept}, {lexicon_batch.SUMS}")


def _token_sums(
    facts: DataFrame, entries: DataFrame, boosters: Mapping[str, float], active_boosters: Mapping[str, float],
    negations: Collection[str], phrases: R.Phrases,
) -> DataFrame:
    """Every token as a narrow row that carries its three predecessors and two successors and meets the lexicon in one
    join. Only hits, and one marker row per post, go on to the sums. Compiled expressions only."""
    text, words = F.col("text"), F.col("words")
    split = F.when(text != "", _split(text)).otherwise(F.array().cast("array<string>"))
    facts = facts.withColumn("words", split).drop("text").withColumn("n_words", F.size(words))

    def shifted(by: int) -> Column:
        # Entry 0 is the marker of the post; the words follow.
        return F.concat(F.array_repeat(F.lit(""), by), words)

    tokens = facts.select(
        *_PER_POST,
        "mixed_case",
        "but_at",
        F.inline(
            F.arrays_zip(
                F.sequence(F.lit(-1), F.col("n_words") - 1).alias("pos"),
                shifted(1).alias("token"),
                *[shifted(d + 1).alias(f"back{d}") for d in (1, 2, 3)],
                words.alias("next1"),
                F.slice(words, 2, F.greatest(F.col("n_words"), F.lit(1))).alias("next2"),
            )
        ),
    ).where(F.col("pos") < F.col("n_words"))
    is_marker = F.col("pos") == -1
    hits = (
        _bare(tokens, "token", "word")
        .join(entries, F.lower("word") == F.col("entry"), "left")
        .where(F.col("valence").isNotNull() | is_marker)
    )
    hits = _with_context(hits, entries, boosters)
    hits = _with_valence(hits, boosters, active_boosters, negations, phrases)
    weight = (
        F.when(F.col("but_at") < 0, 1.0)
        .when(F.col("pos") < F.col("but_at"), R.BEFORE_BUT)
        .when(F.col("pos") > F.col("but_at"), R.AFTER_BUT)
        .otherwise(1.0)
    )
    v = F.when(~is_marker, F.col("v") * weight)
    return hits.withColumn("v", F.coalesce(v, F.lit(0.0))).select(
        *_PER_POST,
        F.col("v").alias("total"),
        F.when(F.col("v") > 0, F.col("v") + 1).otherwise(0.0).alias("up"),
        F.when(F.col("v") < 0, 1 - F.col("v")).otherwise(0.0).alias("down"),
        (F.col("v") != 0).cast("long").alias("hits"),
    )


def _with_context(hits: DataFrame, entries: DataFrame, boosters: Mapping[str, float]) -> DataFrame:
    """Hits with bare, lowered neighbours and whether the next word and the third one back are lexicon words. The
    further joins see hits only."""
    for n in ("next1", "next2", "back1", "back2", "back3"):
        low = n.replace("next", "on").replace("back", "low")
        hits = _bare(hits, n, n).withColumn(low, F.coalesce(F.lower(n), F.lit("")))
    for low in ("on1", "low3"):
        known = entries.select(F.col("entry").alias(f"_{low}"), F.lit(True).alias(f"{low}_known"))
        hits = hits.join(known, F.col(low) == F.col(f"_{low}"), "left").drop(f"_{low}")
    return hits


def _with_valence(
    hits: DataFrame, boosters: Mapping[str, float], active: Mapping[str, float], negations: Collection[str], phrases: R.Phrases
) -> DataFrame:
    """Adds ``v``: valence after capitals, then boosters and negations up to three words back, then phrases.

    One projection per step, so that each intermediate is computed once; nested into one
    expression, every step would repeat the previous one.
    """
    loud = F.when(F.col("mixed_case"), R.CAPS_BOOST).otherwise(0.0)
    low = {d: F.col(f"low{d}") for d in (1, 2, 3)}
    word, has_next = F.lower("word"), F.col("on1") != ""

    def shout(name: str) -> Column:
        return F.when(_is_upper(F.col(name)), loud).otherwise(0.0)

    # A booster word itself carries no sentiment, nor does "no" before a lexicon word or "kind" before "of".
    base = F.when((word == phrases.no) & has_next & F.col("on1_known"), 0.0).otherwise(F.col("valence"))
    after_no = (low[1] == phrases.no) | (low[2] == phrases.no) | ((low[3] == phrases.no) & low[1].isin(*phrases.no_over))
    base = F.when(after_no, F.col("valence") * R.NEGATION_FACTOR).otherwise(base)
    idle = word.isin(list(boosters)) | ((word == phrases.kind[0]) & (F.col("on1") == phrases.kind[1]))
    steps = hits.withColumn("v", F.when(~F.col("entry").isNull() & ~idle, base))
    steps = steps.withColumn("v", F.col("v") + F.signum("v") * shout("word"))
    for d in range(1, len(R.BOOSTER_DAMPING) + 1):
        push = _boost(low[d], active, shout(f"back{d}")) * R.BOOSTER_DAMPING[d - 1]
        factor = _negation(low, d, negations, phrases)
        steps = steps.withColumn("_push", push).withColumn("v", (F.col("v") + F.signum("v") * F.col("_push")) * factor)
    return steps.withColumn("v", _idiom(phrases)).withColumn("v", F.col("v") * _least(phrases))


def _negation(low: Mapping[int, Column], d: int, negations: Collection[str], phrases: R.Phrases) -> Column:
    """Factor of the word ``d`` places back: a negation, unless the words after it make it something else."""
    between = [low[i] for i in range(1, d)]

    def followed(by: Collection[str]) -> Column:
        return reduce(lambda a, b: a | b, [w.isin(list(by)) for w in between], F.lit(False))

    out = F.when(F.lit(False), 1.0)
    if between:
        for word, by in phrases.strengthens.items():
            if word in negations:
                out = out.when((low[d] == word) & followed(by), R.NEVER_FACTOR)
        for word, by in phrases.idle.items():
            if word in negations:
                out = out.when((low[d] == word) & followed(by), 1.0)
    return out.when(_negates(low[d], negations), R.NEGATION_FACTOR).otherwise(1.0)


def _idiom(phrases: R.Phrases) -> Column:
    """Valence after phrases around a word that has three words before it, the first of them no lexicon word."""
    one, two, three, word = F.col("low1"), F.col("low2"), F.col("low3"), F.lower("word")

    def said(*words: Column) -> Column:
        return F.concat_ws(" ", *words)

    def valence(phrase: Column, otherwise: Column) -> Column:
        # one set test for most rows, which hold none of the phrases
        value = reduce(lambda out, kv: out.when(phrase == kv[0], kv[1]), phrases.idioms.items(), F.when(F.lit(False), 0.0))
        return F.when(phrase.isin(list(phrases.idioms)), value).otherwise(otherwise)

    v = F.col("v")
    for phrase in reversed([said(one, word), said(two, one, word), said(two, one), said(three, two, one), said(three, two)]):
        v = valence(phrase, v)
    for phrase in (said(word, F.col("on1")), said(word, F.col("on1"), F.col("on2"))):
        v = valence(phrase, v)
    for phrase in (said(three, two, one), said(three, two), said(two, one)):
        step = reduce(lambda out, kv: out.when(phrase == kv[0], kv[1]), phrases.boosters.items(), F.when(F.lit(False), 0.0))
        v = v + F.when(phrase.isin(list(phrases.boosters)), step).otherwise(0.0)
    return F.when((three != "") & F.col("low3_known").isNull(), v).otherwise(F.col("v"))


def _least(phrases: R.Phrases) -> Column:
    if phrases.least is None:
        return F.lit(1.0)
    least = (F.col("low1") == phrases.least) & ~F.col("low2").isin(list(phrases.least_after))
    return F.when(least, R.NEGATION_FACTOR).otherwise(1.0)


def _boost(lowered: Column, boosters: Mapping[str, float], shout: Column) -> Column:
    out = F
    for step in sorted(set(boosters.values())):
        out = out.when(lowered.isin([w for w, b in boosters.items() if b == step]), step + shout)
    return out.otherwise(0.0) if boosters else F.lit(0.0)


def _negates(lowered: Column, negations: Collection[str]) -> Column:
    return lowered.isin(list(negations)) | lowered.contains("n't")


def _finish(sums: DataFrame) -> DataFrame:
    up, down, emphasis = F.col("up"), F.col("down"), F.col("emphasis")
    stressed = sums.withColumns(
        {
            "total": F.col("total") + F.signum("total") * emphasis,
            "up": F.when(up > down, up + emphasis).otherwise(up),
            "down": F.when(down > up, down + emphasis).otherwise(down),
            "plain": (F.col("n_words") - F.col("hits")).cast("double"),
        }
    )
    mass = F.col("up") + F.col("down") + F.col("plain")

    def share(part: str) -> Column:
        return F.coalesce(F.round(C.safe_div(F.col(part), mass), 3), F.lit(0.0))

    compound = F.round(F.col("total") / F.sqrt(F.col("total") * F.col("total") + R.NORM), 4)
    scored = stressed.select(
        "post_id",
        "subreddit",
        "created_utc",
        compound.alias("compound"),
        share("up").alias("pos"),
        share("plain").alias("neu"),
        share("down").alias("neg"),
        "text_length",
    )
    return scored.select(
        "post_id",
        "subreddit",
        "created_utc",
        "compound",
        "pos",
        "neu",
        "neg",
        label(F.col("compound")).alias("sentiment_label"),
        "text_length",
        F.lit(MODEL_VERSION).alias("model_version"),
    )


def label_summary(scored: DataFrame) -> DataFrame:
    """Posts and mean compound per label."""
    return scored.groupBy("sentiment_label").agg(
        F.count(F.lit(1)).alias("posts"), F.avg("compound").alias("mean_compound")
    )
