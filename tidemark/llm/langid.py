"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``ORDER`` bytes, learned from the texts labelled
with it. A byte that a context has seen c times among n, with t different bytes, costs
-log2(c / (n + t)) bits there; an unseen one first pays the escape, -log2(t / (n + t)), and is coded
by the next shorter context, at last uniformly. Lower orders exclude nothing. The statistics are
frozen after training, so the code length of a text is a sum over its bytes and exact. The language
with the shortest code wins; ties go to the smaller name. ``score`` is its share of probability if
all languages are equally likely beforehand.

The trees are fitted on a bounded sample of labelled rows: of each language at most ``LABELLED_ROWS``, those with the
smallest hash of their text. A context of two or more bytes is kept if the sample holds it ``LEAST`` times. The frozen trees are
bounded by the sample, so they travel with the scoring tasks; every text is scored whole, in a map without a shuffle.

Defined results: a null text and one without a letter (Unicode L) are ``und`` with score 0, and so
is everything if nothing was learned; null languages are not learned; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm import ngrams as N, textops as X
from tidemark.llm.backoff import Backoff, lookup, row_costs
from tidemark.llm.blocks import counts as parts_for, total_bytes
from tidemark.session import settle

ORDER = 4
# Bound of the training sample, as a number of rows of each language.
LABELLED_ROWS = 5_000
LEAST = 2
MOST_BROADCAST = 10_000
UNKNOWN = "und"
# Not a language if its best code is no shorter than this many bits a byte.
MOST_BITS = 8.0
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = X.byte_table([(0x41, 0x5A), (0x61, 0x7A)])
PREDICTED = "lang_pred string, score double, bits_per_byte double"


class Model:
    def __init__(self, languages: list[str], tables: Backoff | None):
        self.languages, self.tables = languages, tables


def sample(labelled: DataFrame, text: str, lang: str, bound: int) -> DataFrame:
    """(lang, text) of at most ``bound`` rows of each language, different texts with the smallest hashes. Rows are thinned
    by the hash first, so that what is shuffled and ranked has a bound; copies are one row."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    keyed = rows.select("lang", "text", F.xxhash64("text").alias("draw"))
    sizes = keyed.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n"), F.min("draw").alias("least"))
    uniform = F.shiftrightunsigned("draw", 11) / F.lit(float(2**53))
    sizes = settle(sizes, "langid-sizes")
    if sizes.count() <= MOST_BROADCAST:  # one small row a language; else texts are shuffled for the join
        sizes = F.broadcast(sizes)
    thin = keyed.join(sizes, "lang").where((uniform * F.col("n") < 2 * bound) | (F.col("draw") == F.col("least")))
    thin = thin.select("lang", "text", "draw").distinct()
    first = Window.partitionBy("lang").orderBy("draw", "text")
    return thin.withColumn("nr", F.row_number().over(first)).where(F.col("nr") <= bound).select("lang", "text")


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, bound: int = LABELLED_ROWS,
          least: int = LEAST) -> Model:
    """Frozen trees of all languages in ``labelled``."""
    rows = settle(sample(labelled, text, lang, bound), "langid-sample")
    shards = max(16, parts_for(total_bytes(rows, "text"), N.SHARD_BYTES))
    grams = N.frequent(settle(N.counts(rows, "lang", "text", order, shards), "langid-grams"), order, least)
    return freeze(grams, order)


def freeze(grams: dict, order: int) -> Model:
    """Code lengths of every known gram and escape costs of every known context, for all languages at once."""
    languages = sorted({name for name, _ in grams})
    if not languages:
        return Model([], None)
    width = len(languages)
    symbols = np.zeros((256, width))
    for i, name in enumerate(languages):
        key, count = grams[name, 0]
        n, t = count.sum(), len(key)
        symbols[:, i] = np.log2((n + t) / t) + 8
        symbols[key.astype(int), i] = np.log2((n + t) / count)
    below_keys, below = np.arange(256, dtype=np.uint64), symbols
    tables, contexts = {}, {}
    for k in range(1, order + 1):
        seen = [grams.get((name, k), (np.zeros(0, np.uint64), np.zeros(0, np.int64))) for name in languages]
        keys = np.unique(np.concatenate([s[0] for s in seen]))
        ctx = np.unique(N.context(keys, k))
        escape = np.zeros((len(ctx), width))
        cost = np.zeros((len(keys), width))
        ctx_at = np.searchsorted(ctx, N.context(keys, k))
        shorter = below[lookup(below_keys, keys >> np.uint64(8))]
        for i, (key, count) in enumerate(seen):
            at = np.searchsorted(ctx, N.context(key, k))
            n, t = np.bincount(at, count, len(ctx)), np.bincount(at, minlength=len(ctx))
            known = t > 0
            escape[known, i] = np.log2((n[known] + t[known]) / t[known])
            cost[:, i] = escape[ctx_at, i] + shorter[:, i]
            cost[np.searchsorted(keys, key), i] = np.log2((n[at] + t[at]) / count)
        tables[k], contexts[k] = (keys, cost), (ctx, escape)
        below_keys, below = keys, cost
    return Model(languages, Backoff(order, tables, contexts, symbols))


def code_lengths(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits of every text under every language, and the texts' bytes."""
    data, bounds = X.text_bytes(column)
    return row_costs(model.tables, data, bounds), np.diff(bounds)


def classify(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and bits a byte of every text of an Arrow column."""
    data, bounds = X.text_bytes(column)
    letters = X.row_sums(_ASCII_LETTER[data], bounds) > 0
    for i in np.flatnonzero(~letters):
        body = column[int(i)].as_py()
        letters[i] = bool(body and _LETTER.search(body))
    if not model.languages:
        return [UNKNOWN] * len(column), np.zeros(len(column)), np.zeros(len(column))
    bits, size = code_lengths(model, column)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(bits)), best]
    score = 1 / np.exp2(np.minimum(0, least[:, None] - bits)).sum(axis=1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
    return names, np.where(letters, score, 0.0), np.where(letters, least / np.maximum(size, 1), 0.0)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, predicted language, score and code length of every row."""
    rows = docs.select(F.col(key), F.col(text).cast("string").alias("__text"))

    def step(batches):
        for batch in batches:
            for part in X.slices(batch, "__text"):
                names, score, bits = classify(model, part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names), pa.array(score), pa.array(bits)],
                    names=[key, "lang_pred", "score", "bits_per_byte"],
                )

    return rows.mapInArrow(step, T.StructType([rows.schema[0], *T._parse_datatype_string(PREDICTED).fields]))


def drop_unidentified(docs: DataFrame, model: Model, text: str = "text", most_bits: float = MOST_BITS) -> DataFrame:
    """The documents with a language, all columns kept: not ``und`` and coded in under ``most_bits`` bits a byte."""

    def step(batches):
        for batch in batches:
            for part in X.slices(batch, text):
                names, _, bits = classify(model, part.column(part.schema.get_field_index(text)))
                good = np.array([n != UNKNOWN for n in names], bool) & (bits < most_bits)
                yield part.filter(pa.array(good))

    return docs.mapInArrow(step, docs.schema)


def held_out(key: str, parts: int):
    """True where the CRC-32 of the key as text leaves 2 modulo ``parts``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts == 2
