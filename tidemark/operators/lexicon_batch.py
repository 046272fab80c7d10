"""Sums of lexicon scoring for Arrow batches of posts.

The rules are those of the token join in :mod:`tidemark.operators.sentiment`. Texts are split and numbered as Arrow arrays.
What depends on a word alone (its bare and lowered form, its valence, what it does to its neighbours) is worked out once
for each different word of a chunk of posts that a rule can name; all others are one number. The rules are
array operations over the hits.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Collection, Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.functions import lexicon_rules as R

# Characters of the posts that are scored at a time; a longer post is a chunk of its own.
CHUNK_CHARS = 2 << 20
OTHER = " "  # no token holds white space
FACTS = ("post_id", "subreddit", "created_utc", "text_length", "emphasis")
SUMS = "n_words int, total double, up double, down double, hits long"


@dataclass(frozen=True)
class Rules:
    """Lexicon and rule words; ``active`` boosters and ``negations`` are those that are no lexicon words."""

    lexicon: Mapping[str, float | None]
    negations: Collection[str]
    boosters: Collection[str]
    active: Mapping[str, float]
    phrases: R.Phrases

    def named(self) -> set[str]:
        """Every word that the lexicon or a rule names."""
        p = self.phrases
        tables = [w for t in (p.strengthens, p.idle) for k, by in t.items() for w in (k, *by)]
        said = [w for t in (p.idioms, p.boosters) for phrase in t for w in phrase.split(" ")]
        single = [w for w in (p.no, p.least, *p.no_over, *p.kind, *p.least_after) if w is not None]
        return {*self.lexicon, *self.negations, *self.boosters, *self.active, *tables, *said, *single}


def bare(token: str) -> str:
    """A token without its outer punctuation, unless too little would remain (emoticons)."""
    inner = token.strip(R.PUNCTUATION)
    return inner if len(inner) > R.KEEP_SHORT else token


def is_upper(word: str) -> bool:
    if word.isascii():
        return word.isupper()
    kinds = {unicodedata.category(c) for c in word}
    return "Lu" in kinds and "Ll" not in kinds


@cache
def _recased() -> str:
    """Pattern of the characters beyond ASCII that Python's lower case changes."""
    return "[" + "".join(c for c in map(chr, range(0x80, 0x110000)) if c.lower() != c) + "]"


def told(tokens: pa.Array, named: pa.Array) -> np.ndarray:
    """Tokens that some rule may name. Lower case is Arrow's for ASCII alone; a token in which it would change more counts
    as one."""
    inner = pc.ascii_trim(tokens, characters=R.PUNCTUATION)
    low = pc.ascii_lower(pc.if_else(pc.greater(pc.utf8_length(inner), R.KEEP_SHORT), inner, tokens))
    can = pc.or_(pc.is_in(low, named), pc.match_substring(low, "n't"))
    return pc.or_(can, pc.match_substring_regex(low, _recased())).to_numpy(zero_copy_only=False).astype(bool)


class Words:
    """The different words of a chunk: numbers of their lowered forms and their properties. 0 is no word, 1 any word
    that no rule names."""

    def __init__(self, tokens: pa.Array, rules: Rules, named: pa.Array):
        kept = told(tokens, named)
        shown = [bare(n) for n in tokens.filter(pa.array(kept)).to_pylist()]
        self.number = {"": 0, OTHER: 1}
        self.low = np.ones(len(tokens), np.int64)
        self.low[kept] = [self.number.setdefault(w.lower(), len(self.number)) for w in shown]
        self.upper = np.zeros(len(tokens), bool)
        self.upper[kept] = [is_upper(w) for w in shown]
        lowered = list(self.number)
        values = [rules.lexicon.get(w) for w in lowered]
        self.entry = np.array([w in rules.lexicon for w in lowered], bool)
        self.valued = np.array([v is not None for v in values], bool)
        self.valence = np.array([v or 0.0 for v in values], np.float64)
        self.idle = self.among(rules.boosters)
        self.boosts = self.among(rules.active)
        self.step = np.array([rules.active.get(w, 0.0) for w in lowered], np.float64)
        self.negates = self.among(rules.negations) | np.array(["n't" in w for w in lowered], bool)

    def of(self, word: str | None) -> int:
        return self.number.get(word, -1)

    def among(self, words: Iterable[str]) -> np.ndarray:
        found = np.zeros(len(self.number), bool)
        found[[self.number[w] for w in words if w in self.number]] = True
        return found


def sums(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """One row per post: :data:`FACTS`, its words and the sums of its valences."""
    named = pa.array(sorted(rules.named()), pa.string())
    for batch in batches:
        texts = batch.column("text")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, chars in enumerate(sizes.tolist(), 1):
            size += chars
            if size >= CHUNK_CHARS or i == len(texts):
                part = batch.slice(start, i - start)
                found = _score(part.column("text"), part.column("mixed_case"), part.column("but_at"), rules, named)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in FACTS], *[pa.array(v) for v in found.values()]], names=[*FACTS, *found]
                )
                start, size = i, 0


def _tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of each text, the different tokens, and the number of each token in order."""
    lists = pc.utf8_split_whitespace(texts)
    tokens, owner = lists.flatten(), pc.list_parent_indices(lists)
    full = pc.not_equal(tokens, "")
    if not pc.all(full, min_count=0).as_py():  # an empty text, or space at an end
        tokens, owner = tokens.filter(full), owner.filter(full)
    n = np.bincount(owner.to_numpy(zero_copy_only=False), minlength=len(texts)).astype(np.int32)
    coded = tokens.dictionary_encode()
    return n, coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def _score(texts: pa.Array, mixed_case: pa.Array, but_at: pa.Array, rules: Rules, named: pa.Array) -> dict[str, np.ndarray]:
    n, names, code = _tokens(texts)
    words = Words(names, rules, named)
    low = words.low[code]
    hit = np.flatnonzero(words.valued[low])
    post = np.repeat(np.arange(len(n)), n)[hit]
    pos = hit - (np.cumsum(n) - n)[post]

    def place(by: int) -> tuple[np.ndarray, np.ndarray]:
        there = (pos + by >= 0) & (pos + by < n[post])
        return np.where(there, hit + by, 0), there

    def near(by: int) -> np.ndarray:
        at, there = place(by)
        return np.where(there, low[at], 0)

    loud = np.where(mixed_case.to_numpy(zero_copy_only=False).astype(bool), R.CAPS_BOOST, 0.0)[post]

    def shout(by: int) -> np.ndarray:
        at, there = place(by)
        return np.where(there & words.upper[code[at]], loud, 0.0)

    v, known = _valence({d: near(d) for d in (-3, -2, -1, 0, 1, 2)}, shout, words, rules)
    but = but_at.to_numpy()[post]
    v = v * np.where(but < 0, 1.0, np.where(pos < but, R.BEFORE_BUT, np.where(pos > but, R.AFTER_BUT, 1.0)))
    v = np.where(known, v, 0.0)

    def total(x: np.ndarray) -> np.ndarray:
        return np.bincount(post, x, len(n)).astype(np.float64)  # no hits: integers

    return {
        "n_words": n, "total": total(v), "up": total(np.where(v > 0, v + 1, 0.0)), "down": total(np.where(v < 0, 1 - v, 0.0)),
        "hits": np.bincount(post[v != 0], minlength=len(n)).astype(np.int64),
    }


def _valence(low: Mapping[int, np.ndarray], shout, words: Words, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """Valence of each hit after capitals, boosters, negations and phrases, and whether it has one. ``low`` holds the
    lowered word and its neighbours by distance."""
    phrases, word, no = rules.phrases, low[0], words.of(rules.phrases.no)
    v = words.valence[word]
    after_no = (low[-1] == no) | (low[-2] == no) | ((low[-3] == no) & words.among(phrases.no_over)[low[-1]])
    silent = (word == no) & (low[1] != 0) & words.entry[low[1]]
    v = np.where(after_no, v * R.NEGATION_FACTOR, np.where(silent, 0.0, v))
    known = ~(words.idle[word] | ((word == words.of(phrases.kind[0])) & (low[1] == words.of(phrases.kind[1]))))
    v = v + np.sign(v) * shout(0)
    for d, damping in enumerate(R.BOOSTER_DAMPING, 1):
        push = np.where(words.boosts[low[-d]], words.step[low[-d]] + shout(-d), 0.0) * damping
        v = (v + np.sign(v) * push) * _negation(low, d, words, rules)
    v, known = _idiom(low, v, known, words, phrases)
    if phrases.least is not None:
        least = (low[-1] == words.of(phrases.least)) & ~words.among(phrases.least_after)[low[-2]]
        v = v * np.where(least, R.NEGATION_FACTOR, 1.0)
    return v, known


def _negation(low: Mapping[int, np.ndarray], d: int, words: Words, rules: Rules) -> np.ndarray:
    """Factor of the word ``d`` places back: a negation, unless the words after it make it something else."""
    out = np.where(words.negates[low[-d]], R.NEGATION_FACTOR, 1.0)
    for table, factor in ((rules.phrases.idle, 1.0), (rules.phrases.strengthens, R.NEVER_FACTOR)):
        for word, by in table.items():
            if word in rules.negations and word in words.number:
                after = words.among(by)
                for i in range(1, d):
                    out[(low[-d] == words.of(word)) & after[low[-i]]] = factor
    return out


def _idiom(low: Mapping[int, np.ndarray], v: np.ndarray, known: np.ndarray, words: Words, phrases: R.Phrases):
    """Valence after phrases around a word that has three words before it, the first of them no lexicon word."""
    after, told = v.copy(), known.copy()

    def said(places: tuple[int, ...], table: Mapping[str, float]):
        for phrase, value in table.items():
            parts = [words.of(p) for p in phrase.split(" ")]
            if len(parts) == len(places) and -1 not in parts:
                match = low[places[0]] == parts[0]
                for place, part in zip(places[1:], parts[1:]):
                    match &= low[place] == part
                yield match, value

    for places in ((-3, -2), (-3, -2, -1), (-2, -1), (-2, -1, 0), (-1, 0), (0, 1), (0, 1, 2)):
        for match, value in said(places, phrases.idioms):
            after[match], told[match] = value, True
    for places in ((-3, -2, -1), (-3, -2), (-2, -1)):
        for match, value in said(places, phrases.boosters):
            after[match] += value
    applies = (low[-3] != 0) & ~words.entry[low[-3]]
    return np.where(applies, after, v), np.where(applies, told, known)
