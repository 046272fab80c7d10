"""Quality classifier: perplexity under a modified Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney byte model with contexts of up to ``ORDER`` bytes.
Trusted documents are parted in two by a hash of their id. The model is trained on the whole first part
and lives in shards by the two latest context bytes, so that all counts that the grams of one
context need are together; grams with shorter contexts are at most 65,792 and travel with the tasks.
Blocks of documents ask each shard once for all their distinct grams, the shard joins them with its
counts and answers with log-probabilities. Shards grow in number with the trusted text. Requests of ``SALT_BLOCKS``
blocks at most meet in one task (of more, where shards are more and each is asked for less), and a shard's counts are
copied for each such number of blocks: copies of the model do not grow with the corpus once shards do.

A document's perplexity is that of one byte. Each language has its own threshold: the ``QUANTILE``
of the perplexities of the second part's documents of that language. A language
without such documents takes the quantile over all of them, and with none at all nothing is dropped.

Defined results: a null or empty text has no perplexity and is not kept; a null language is a
language of its own; trusted ids that are null, repeated or absent from the documents do nothing
more; other columns are ignored; with no trusted text every byte has probability 1/256.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import blocks as B, ngrams as N, textops as X
from tidemark.llm.backoff import lookup
from tidemark.session import settle

ORDER = 4
QUANTILE = 0.99
# Bound of the trusted documents to learn from; none: all of them.
TRUSTED_ROWS = None
# Shards at least, and trusted text for each.
SHARDS = 32
SHARD_TEXT = 16 << 20
# Ids are 8 bytes each: the broadcast stays below 100 MB.
MAX_BROADCAST_IDS = 4_000_000
SALT_BLOCKS = 256
JUDGED = "doc_id long, lang string, n_bytes long, perplexity double"


def part(trusted: DataFrame, doc_id: str, which: int) -> DataFrame:
    """The distinct ids of half of the trusted documents: 0 to learn from, 1 to set thresholds by."""
    ids = trusted.select(F.col(doc_id).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    return ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == which)


def sample(trusted: DataFrame, doc_id: str, bound: int | None = TRUSTED_ROWS) -> DataFrame:
    """The ids of all trusted documents to learn from, or of at most ``bound`` of them if a caller wants fewer."""
    ids = part(trusted, doc_id, 0)
    return ids if bound is None else ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


class Discounts:
    """Modified Kneser-Ney discounts of one order from its counts of counts."""

    def __init__(self, counts: np.ndarray):
        n = [0, *[float(counts[i]) for i in range(4)]]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        ratio = [n[i + 1] / n[i] if n[i] else 0.0 for i in (1, 2, 3)]
        raw = [1 - 2 * y * ratio[0], 2 - 3 * y * ratio[1], 3 - 4 * y * ratio[2]]
        self.by_count = np.array([0.0, *[min(max(d, 0.05), 0.95 * i) for i, d in enumerate(raw, 1)]])

    def of(self, count: np.ndarray) -> np.ndarray:
        return self.by_count[np.minimum(count, 3)]


def continued(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams one order below, each with the number of different grams that end in it."""
    short = key >> np.uint64(8)
    at = X.run_starts(short)
    return short[at], np.diff(np.append(at, len(short)))


def orders(key: np.ndarray, count: np.ndarray, order: int, lowest: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Raw counts at the highest order and continuation counts down to ``lowest``."""
    out = {order: (key, count)}
    for k in range(order - 1, lowest - 1, -1):
        out[k] = continued(out[k + 1][0])
    return out


def interpolate(key: np.ndarray, count: np.ndarray, k: int, d: Discounts, shorter):
    """(contexts, their back-off weights, probabilities of the seen grams); ``shorter(keys)`` gives p one order below."""
    ctx, at = np.unique(N.context(key, k), return_inverse=True)
    n = np.bincount(at, count, len(ctx))
    weight = np.bincount(at, d.of(count), len(ctx)) / n
    below = shorter(key >> np.uint64(8)) if k else np.full(len(key), 1 / 256)
    return ctx, weight, (count - d.of(count)) / n[at] + weight[at] * below


class Low:
    """Probabilities at orders 0 and 1, dense."""

    def __init__(self, pairs: tuple[np.ndarray, np.ndarray], d0: Discounts, d1: Discounts):
        self.zero = np.full(256, 1 / 256)
        self.one = np.tile(self.zero[:, None], (1, 256))  # [symbol, latest byte]
        key, count = pairs
        if not len(key):
            return
        single, seen = continued(key)
        _, weight, p = interpolate(single, seen, 0, d0, None)
        self.zero = np.full(256, weight[0] / 256)
        self.zero[single.astype(int)] = p
        ctx, weight, p = interpolate(key, count, 1, d1, lambda x: self.zero[x.astype(int)])
        self.one = np.tile(self.zero[:, None], (1, 256))
        self.one[:, ctx.astype(int)] *= weight
        self.one[(key >> np.uint64(8)).astype(int), (key & np.uint64(255)).astype(int)] = p

    def of(self, key: np.ndarray) -> np.ndarray:
        return self.one[(key >> np.uint64(8)).astype(int), (key & np.uint64(255)).astype(int)]


def _statistics(counted: DataFrame, order: int) -> tuple[dict[int, Discounts], Low]:
    """Discounts of every order and the low-order model; what shards send to the driver has a fixed size."""

    def step(batches):
        for batch in batches:
            for raw_keys, raw_counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                levels = orders(B.unsqueeze(raw_keys, np.uint64), B.unsqueeze(raw_counts, np.int64), order, 1)
                rows = [(k, np.bincount(np.minimum(c, 5), minlength=6)[1:5].tolist()) for k, (_, c) in levels.items() if k > 1]
                pairs = levels[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in rows] + [1], pa.int32()), pa.array([c for _, c in rows] + [[]], pa.list_(pa.int64())),
                     pa.array([None] * len(rows) + [B.squeeze(pairs[0])], pa.binary()),
                     pa.array([None] * len(rows) + [B.squeeze(pairs[1])], pa.binary())],
                    names=["k", "n", "keys", "counts"])

    totals = {k: np.zeros(4) for k in range(order + 1)}
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    found = counted.select("keys", "counts").mapInArrow(step, "k int, n array<long>, keys binary, counts binary")
    for k, n, raw_keys, raw_counts in found.toLocalIterator():
        if k > 1:
            totals[k] += n
        else:
            keys.append(B.unsqueeze(raw_keys, np.uint64))
            counts.append(B.unsqueeze(raw_counts, np.int64))
    pairs = N.summed(np.concatenate(keys), np.concatenate(counts))
    for k, c in ((1, pairs[1]), (0, continued(pairs[0])[1])):
        totals[k] += np.bincount(np.minimum(c, 5), minlength=6)[1:5]
    d = {k: Discounts(n) for k, n in totals.items()}
    return d, Low(pairs, d[0], d[1])


def shard_log2(asked: np.ndarray, key: np.ndarray, count: np.ndarray, order: int, d: dict[int, Discounts], low: Low) -> np.ndarray:
    """log2 probability of each asked gram, joined with the counts of its shard."""
    levels = orders(key, count, order, 2)
    known: dict[int, tuple] = {}

    def below(k):
        if k == 1:
            return low.of
        keys, p = known[k][0], known[k][3]
        return lambda x: p[lookup(keys, x)]  # suffixes of seen grams are seen

    for k in range(2, order + 1):
        keys, counts = levels[k]
        known[k] = (keys, *interpolate(keys, counts, k, d[k], below(k - 1)))
    p = low.of(asked >> np.uint64(8 * (order - 1)))
    for k in range(2, order + 1):
        gram = asked >> np.uint64(8 * (order - k))
        keys, ctx, weight, probs = known[k]
        at = lookup(ctx, N.context(gram, k))
        if len(ctx):
            p = np.where(at >= 0, p * weight[at], p)
        at = lookup(keys, gram)
        if len(keys):
            p = np.where(at >= 0, probs[at], p)
    return np.log2(p)


def perplexity(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
               order: int = ORDER, shards: int | None = None) -> DataFrame:
    """doc_id, lang, bytes and perplexity of every document under a model of the texts whose ids ``trusted`` (a
    column ``doc_id``) holds. ``shards`` follows the trusted text unless given."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    ids = F.broadcast(trusted) if trusted.count() <= MAX_BROADCAST_IDS else trusted
    chosen = rows.join(ids, "doc_id", "left_semi").select(F.lit("").alias("grp"), "text")
    shards = shards or max(SHARDS, B.counts(B.total_bytes(chosen, "text"), SHARD_TEXT))
    counted = settle(N.counts(chosen, "grp", "text", order, shards), "quality-grams")
    d, low = _statistics(counted, order)
    total = B.total_bytes(rows, "text")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), B.counts(total, 64 << 20))
    salts = B.counts(total, max(1, SALT_BLOCKS * B.BLOCK_BYTES // 2 * shards // SHARDS))
    packed = B.pack_by_arrival(rows, "text", partitions)

    def grams_of(payloads, places=True):
        table = pa.concat_tables([B.unpack(p) for p in payloads]).combine_chunks()
        data, bounds = X.text_bytes(table.column("text").combine_chunks())
        key = N.keys(data, bounds, order).view(np.int64)
        code, names = pd.factorize(key) if places else (None, pd.unique(key))
        sort = np.argsort(names.view(np.uint64))
        distinct, which = names.view(np.uint64)[sort], None
        if places:
            rank = np.empty(len(names), np.int64)
            rank[sort] = np.arange(len(names))
            which = rank[code]
        runs, edges = B.shard_runs(N.shard_of(distinct, order, shards), shards)
        return table, bounds, distinct, which, runs, edges

    def ask(key, packed_rows):
        _, _, distinct, _, runs, edges = grams_of(packed_rows.column("payload").to_pylist(), places=False)
        salt = int(X.mix(np.array([key[0].as_py()], X.U64))[0] % X.U64(salts))
        out = [
            (s, salt, key[0].as_py(), B.squeeze(np.diff(distinct[runs[a:b]], prepend=X.U64(0))))
            for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a
        ]
        return _table(out, ["shard", "salt", "block", "grams"], [pa.int64(), pa.int32(), pa.int64(), pa.binary()])

    def answer(key, asked, held):
        if not asked.num_rows:
            return _table([], ["block", "shard", "bits"], [pa.int64(), pa.int64(), pa.binary()])
        keys = [np.cumsum(B.unsqueeze(x, np.uint64), dtype=X.U64) for x in asked.column("grams").to_pylist()]
        if held.num_rows:
            mine = B.unsqueeze(held.column("keys")[0].as_py(), np.uint64), B.unsqueeze(held.column("counts")[0].as_py(), np.int64)
        else:
            mine = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        bits = shard_log2(distinct, *mine, order, d, low).astype(np.float32)[which]
        out, at = [], 0
        for block, own in zip(asked.column("block").to_pylist(), keys):
            out.append((block, key[0].as_py(), B.squeeze(bits[at : at + len(own)])))
            at += len(own)
        return _table(out, ["block", "shard", "bits"], [pa.int64(), pa.int64(), pa.binary()])

    def judge(key, packed_rows, answers):
        names, kinds = ["doc_id", "lang", "n_bytes", "perplexity"], [pa.int64(), pa.string(), pa.int64(), pa.float64()]
        if not packed_rows.num_rows:
            return _table([], names, kinds)
        table, bounds, distinct, which, runs, _ = grams_of(packed_rows.column("payload").to_pylist())
        bits = np.zeros(len(distinct), np.float64)
        told = [B.unsqueeze(x, np.float32) for x in answers.sort_by("shard").column("bits").to_pylist()]
        bits[runs] = np.concatenate([np.zeros(0, np.float32), *told])
        size = np.diff(bounds)
        mean = -X.row_sums(bits[which], bounds) / np.maximum(size, 1)
        return pa.table([table.column("doc_id"), table.column("lang"), pa.array(size),
                         pa.array(np.exp2(mean), mask=size == 0)], names=names)

    asked = packed.groupBy("block").applyInArrow(ask, "shard long, salt int, block long, grams binary").repartition(partitions, "shard", "salt")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    held = counted.select("shard", copies, "keys", "counts").repartition(partitions, "shard", "salt")
    told = asked.groupBy("shard", "salt").cogroup(held.groupBy("shard", "salt")).applyInArrow(answer, "block long, shard long, bits binary")
    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(judge, JUDGED)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             quality: str = "quality", bound: int | None = TRUSTED_ROWS, quantile: float = QUANTILE, order: int = ORDER) -> DataFrame:
    """doc_id, lang, perplexity, threshold of the language and the verdict ``keep`` for every document."""
    trusted = labels.where(F.col(quality) == 1)
    chosen = settle(sample(trusted, doc_id, bound), "quality-trusted")
    judged = settle(perplexity(docs, chosen, doc_id, text, lang, order), "quality-judged")
    held = judged.join(part(trusted, doc_id, 1), "doc_id", "left_semi").where("perplexity IS NOT NULL")
    # one row per language and one for all of them
    marks = held.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("own"))
    overall = held.agg(F.percentile_approx("perplexity", quantile, 10_000)).first()[0]
    joined = judged.join(marks.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left").drop("l")
    mark = F.coalesce("own", F.lit(overall).cast("double"), F.lit(float("inf")))
    return joined.select(
        "doc_id", "lang", "n_bytes", "perplexity", mark.alias("threshold"),
        F.coalesce(F.col("perplexity") <= mark, F.lit(False)).alias("keep"),
    )


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)
