"""Whole-word term flags for free text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Tracked assets and the words that count as a mention of each.
ASSET_TERMS: dict[str, tuple[str, ...]] = {
    "BTC": ("BTC", "BITCOIN"),
    "ETH": ("ETH", "ETHEREUM"),
    "SOL": ("SOL", "SOLANA"),
    "ADA": ("ADA", "CARDANO"),
    "XRP": ("XRP", "RIPPLE"),
    "DOGE": ("DOGE", "DOGECOIN"),
}

WORD_CHAR = r"[\p{L}\p{N}_]"
NOT_WORD_CHAR = r"[^\p{L}\p{N}_]"


def word_pattern(words: Sequence[str]) -> str:
    """Case-insensitive pattern matching any of ``words`` as whole words.

    Word edges are spelled out as Unicode classes: what ``\\b`` means for accented
    letters differs between regex engines and JDK versions. The word comes first and its edges
    are looked at where it was found, so that most of a text costs one comparison a character.
    """
    found = (rf"{w}(?<!{WORD_CHAR}{w})" for w in map(re.escape, words))
    return rf"(?i)(?:{'|'.join(found)})(?!{WORD_CHAR})"


def mention_column(symbol: str) -> str:
    return f"mentions_{symbol.lower()}"


def _may_hold(lowered: Column, words: Sequence[str]) -> Column | None:
    """False only for texts that hold none of ``words``: a substring test, then the plain word and its edges. None for
    words whose lower case in a text depends on what is around them."""
    if not words or not all(c.isascii() or c.islower() for w in words for c in w):
        return None

    def holds(word: str) -> Column:
        w = re.escape(word)
        return lowered.contains(word) & lowered.rlike(rf"{w}(?<!{WORD_CHAR}{w})(?!{WORD_CHAR})")

    return reduce(lambda a, b: a | b, [holds(w.lower()) for w in words])


def mention_flags(text: Column, terms: Mapping[str, Sequence[str]]) -> list[Column]:
    """Whether ``text`` mentions each symbol. The pattern runs on texts that a cheaper test leaves."""
    lowered = F.lower(text)

    def flag(words: Sequence[str]) -> Column:
        may, exact = _may_hold(lowered, words), text.rlike(word_pattern(words))
        return exact if may is None else may & exact

    return [flag(words).alias(mention_column(symbol)) for symbol, words in terms.items()]
