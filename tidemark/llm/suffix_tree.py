"""Language-model scoring with a probabilistic suffix tree over bytes.

A text is read as its lower-cased words (A-Z only), one space between two and a line feed after the
last. The tree holds contexts of up to ``ORDER`` bytes. A context of two or more bytes is a candidate if the training
texts hold it ``LEAST`` times or more, and is retained if its next-byte distribution diverges from that of
its longest shorter context by ``DIVERGENCE`` bits or more, or if a longer retained context needs it; contexts of up
to one byte are all retained. Next-byte distributions are smoothed towards that shorter context:
(c + SMOOTH * p') / (n + SMOOTH), and at the root towards the uniform distribution. Every byte is scored in the state
of the longest retained suffix of what precedes it; the score of a text is the log10 probability of its bytes.

All training texts are counted, and more text gives more contexts: nothing is cut by its share. The tree lives in hash
shards by the two latest bytes, so that a context and all its suffixes are together; only the 65,792 numbers of
contexts of up to one byte travel with the tasks. Blocks of documents ask each shard that concerns them once for all
their distinct grams, and the shards of the vocabulary for all their distinct words, which ``base_score`` needs; shards
answer with probabilities, and with counts over the whole corpus. Requests of ``SALT_BLOCKS`` blocks at most meet in
one task: a shard of the tree is copied for each such number of blocks, so frequent contexts make no hot shard.

A task holds a block of documents, about 8 MB of text or one longer text. Grams are made ``N.PIECE`` bytes at a time, so
beside the text it holds its distinct grams and its words, not a gram for each byte.

Defined results: null texts are empty and consist of the end token alone; rows are scored one by one,
so repeated rows repeat; a null doc_id counts as the empty text for the held-out rule and is never
held out; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import blocks as B, ngrams as N, textops as X
from tidemark.llm.backoff import lookup
from tidemark.session import settle

ORDER = 6
LEAST = 2
DIVERGENCE = 0.02
SMOOTH = 4.0
END = X.mix(np.array([0], X.U64), 99)[0]
SHARD_TEXT = 48 << 20
SALT_BLOCKS = 256
ASKED = "kind int, shard long, salt int, block long, keys binary, counts binary"
TOLD = "kind int, block long, shard long, reply binary, n long, v long"
WORDS, GRAMS = 0, 1
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, vocabulary long, "
    "base_score double, score double"
)


def stream(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words of every row, a space between two and a line feed at the end."""
    data = np.insert(X.LOWER[data], bounds[1:], 0x0A)  # now every word has a separator after it
    bounds = bounds + np.arange(len(bounds))
    inside = X.NOT_SPACE[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1] & ~inside[1:]
    size = np.add.reduceat(keep, bounds[:-1], dtype=np.int64)
    empty = size == 0  # one line feed each
    keep[bounds[1:][empty] - 1] = True
    edges = np.concatenate([[0], np.cumsum(size + empty)])
    out = np.where(inside, data, np.uint8(0x20))[keep]
    out[edges[1:] - 1] = 0x0A
    return out, edges


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of every row, the end token last, and the rows' bounds."""
    data = X.LOWER[data]
    starts, ends, word_bounds = X.word_spans(data, bounds, X.NOT_SPACE)
    hashes = X.word_hashes(data, starts, ends)
    return np.insert(hashes, word_bounds[1:], END), word_bounds + np.arange(len(word_bounds))


@dataclass(frozen=True)
class Tree:
    """Gram counts in shards (a stored table), the dense low orders, and what the tree is made with."""

    counted: DataFrame
    low: np.ndarray  # [byte, byte before it]: probability
    shards: int
    order: int
    least: int
    divergence: float
    smooth: float


def learn(train: DataFrame, text: str = "text", order: int = ORDER, least: int = LEAST,
          divergence: float = DIVERGENCE, smooth: float = SMOOTH) -> Tree:
    rows = train.select(F.lit("").alias("grp"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    shards = max(32, B.counts(B.total_bytes(rows, "text"), N.SHARD_BYTES))
    counted = settle(N.counts(rows, "grp", "text", order, shards, stream).select("shard", "keys", "counts"), "suffix-grams")
    return Tree(counted, low_orders(counted, order, smooth), shards, order, least, divergence, smooth)


def low_orders(counted: DataFrame, order: int, smooth: float) -> np.ndarray:
    """Smoothed probability of every byte after every byte. What shards send are sums over pairs of bytes."""

    def step(batches):
        for batch in batches:
            for raw_keys, raw_counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key, count = B.unsqueeze(raw_keys, np.uint64), B.unsqueeze(raw_counts, np.int64)
                for _ in range(order - 1):
                    key, count = N.lower(key, count)
                yield pa.RecordBatch.from_arrays([pa.array([B.squeeze(key)], pa.binary()), pa.array([B.squeeze(count)], pa.binary())], names=["keys", "counts"])

    pairs = np.zeros((256, 256))
    for raw_keys, raw_counts in counted.select("keys", "counts").mapInArrow(step, "keys binary, counts binary").toLocalIterator():
        key = B.unsqueeze(raw_keys, np.uint64)
        pairs[(key >> X.U64(8)).astype(int), (key & X.U64(255)).astype(int)] += B.unsqueeze(raw_counts, np.int64)
    root = (pairs.sum(axis=1) + smooth / 256) / (pairs.sum() + smooth)
    return (pairs + smooth * root[:, None]) / (pairs.sum(axis=0) + smooth)


def _of(low: np.ndarray, key: np.ndarray) -> np.ndarray:
    return low[(key >> X.U64(8)).astype(int), (key & X.U64(255)).astype(int)]


def shard_log10(asked: np.ndarray, key: np.ndarray, count: np.ndarray, low: np.ndarray, order: int, least: int,
                divergence: float, smooth: float) -> np.ndarray:
    """log10 probability of each asked gram, from the gram counts of its shard: candidates are tested and retained, and
    the longest retained context of the gram is found."""
    levels = {order: (key, count)}
    for k in range(order - 1, 1, -1):
        levels[k] = N.lower(*levels[k + 1])
    grams, ctxs, seen, keep, known = {}, {}, {}, {}, {}
    for k in range(2, order + 1):
        key, count = levels[k]
        ctx, at = np.unique(N.context(key, k), return_inverse=True)
        n = np.bincount(at, count, len(ctx))
        good = n >= least
        here = good[at]
        key, count, at = key[here], count[here], (np.cumsum(good) - 1)[at[here]]
        ctx, n = ctx[good], n[good]
        # the shorter context is a candidate too, and has seen the byte
        below = _of(low, key >> X.U64(8)) if k == 2 else known[k - 1][lookup(grams[k - 1], key >> X.U64(8))]
        known[k] = (count + smooth * below) / (n[at] + smooth)
        gain = np.bincount(at, count / n[at] * np.log2(count / n[at] / below), len(ctx))
        grams[k], levels[k], ctxs[k], seen[k], keep[k] = key, (key, count), ctx, n, gain >= divergence
    for k in range(order, 2, -1):  # suffixes of retained contexts stay
        needed = lookup(ctxs[k - 1], np.unique(ctxs[k][keep[k]] >> X.U64(8)))
        keep[k - 1][needed[needed >= 0]] = True
    p = _of(low, asked >> X.U64(8 * (order - 1)))
    left, state = asked, np.arange(len(asked))  # grams whose context of the last order was retained
    for k in range(2, order + 1):
        gram = left >> X.U64(8 * (order - k))
        ctx, n = ctxs[k][keep[k]], seen[k][keep[k]]
        at = lookup(ctx, N.context(gram, k))
        state, gram, left, at = state[at >= 0], gram[at >= 0], left[at >= 0], at[at >= 0]
        if not len(state):
            break
        found = lookup(grams[k], gram)
        c = np.where(found >= 0, levels[k][1][found], 0)
        p[state] = (c + smooth * p[state]) / (n[at] + smooth)
    return np.log10(p)


def score(docs: DataFrame, tree: Tree, doc_id: str = "doc_id", text: str = "text", held_out=None) -> DataFrame:
    """One row per document; rows for which ``held_out`` (a boolean column) holds don't count as training text."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))).alias("held_out"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    total = B.total_bytes(rows, "text")
    shards = B.counts(total, SHARD_TEXT)
    salts = B.counts(total, SALT_BLOCKS * B.BLOCK_BYTES // 2)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), B.counts(total, 64 << 20))
    packed = B.pack_by_arrival(rows, "text", partitions)
    low, order, tree_shards = tree.low, tree.order, tree.shards
    made_with = (order, tree.least, tree.divergence, tree.smooth)

    def distinct(values):
        """The distinct values in order, and the place of each value among them."""
        code, names = pd.factorize(values.view(np.int64))
        sort = np.argsort(names.view(np.uint64))
        rank = np.empty(len(names), np.int64)
        rank[sort] = np.arange(len(names))
        return names.view(np.uint64)[sort], rank[code]

    def read(packed_rows):
        table = pa.concat_tables([B.unpack(p) for p in packed_rows.column("payload").to_pylist()]).combine_chunks()
        return table, *X.text_bytes(table.column("text").combine_chunks())

    def words_of(data, bounds):
        hashes, edges = tokens(data, bounds)
        names, which = distinct(hashes)
        return names, which, edges, *B.shard_runs((X.mix(names, 7) % X.U64(shards)).astype(np.int64), shards)

    def grams_of(data, bounds):
        names = N.distinct(data, bounds, order)
        return names, *B.shard_runs(N.shard_of(names, order, tree_shards), tree_shards)

    def ask(key, packed_rows):
        block, out = key[0].as_py(), []
        salt = int(X.mix(np.array([block], X.U64))[0] % X.U64(salts))
        table, data, bounds = read(packed_rows)
        ask_words(out, block, table, data, bounds)
        names, runs, cuts = grams_of(*stream(data, bounds))
        for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                out.append((GRAMS, s, salt, block, B.squeeze(np.diff(names[runs[a:b]], prepend=X.U64(0))), None))
        return _table(out, ["kind", "shard", "salt", "block", "keys", "counts"],
                      [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    def ask_words(out, block, table, data, bounds):
        names, which, edges, runs, cuts = words_of(data, bounds)
        train = ~np.repeat(table.column("held_out").to_numpy(), np.diff(edges))
        seen = np.bincount(which[train], minlength=len(names)).astype(np.uint32)
        for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                out.append((WORDS, s, 0, block, names[runs[a:b]].tobytes(), B.squeeze(seen[runs[a:b]])))

    def answer(key, asked, held):
        kind, shard = key[0].as_py(), key[1].as_py()
        out, extra = [], []
        if asked.num_rows and kind == WORDS:
            keys = [np.frombuffer(x, X.U64) for x in asked.column("keys").to_pylist()]
            seen = np.concatenate([B.unsqueeze(x, np.uint32) for x in asked.column("counts").to_pylist()]).astype(np.int64)
            names, which = distinct(np.concatenate(keys))
            reply = np.bincount(which, seen, len(names)).astype(np.int64)
            extra = [(kind, -1, shard, None, int(reply.sum()), int((reply > 0).sum()))]
        elif asked.num_rows:
            keys = [np.cumsum(B.unsqueeze(x, np.uint64), dtype=X.U64) for x in asked.column("keys").to_pylist()]
            names = np.sort(np.concatenate(keys))
            names = names[X.run_starts(names)]
            mine = (B.unsqueeze(held.column(c)[0].as_py(), t) for c, t in (("keys", np.uint64), ("counts", np.int64))) if held.num_rows else (
                np.zeros(0, np.uint64), np.zeros(0, np.int64))
            reply = shard_log10(names, *mine, low, *made_with).astype(np.float32)
        for block, own in zip(asked.column("block").to_pylist(), keys if asked.num_rows else []):
            out.append((kind, block, shard, B.squeeze(reply[np.searchsorted(names, own)]), None, None))
        return _table(out + extra, ["kind", "block", "shard", "reply", "n", "v"],
                      [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()])

    by = ["kind", "shard", "salt"]
    asked = packed.groupBy("block").applyInArrow(ask, ASKED).repartition(partitions, *by)
    held = tree.counted.select(
        F.lit(GRAMS).alias("kind"), "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "keys", "counts"
    ).repartition(partitions, *by)
    told = settle(asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(answer, TOLD), "suffix-told")
    n, v = (x or 0 for x in told.where("block = -1").agg(F.sum("n"), F.sum("v")).first())

    def judge(key, packed_rows, answers):
        if not packed_rows.num_rows:
            return _table([], SCORED_NAMES, SCORED_KINDS)
        table, data, bounds = read(packed_rows)
        answers = answers.sort_by("shard")
        kinds, replies = answers.column("kind").to_pylist(), answers.column("reply").to_pylist()

        def replied(kind, dtype, names, runs):
            out = np.zeros(len(names), dtype)
            out[runs] = np.concatenate([B.unsqueeze(x, dtype) for k, x in zip(kinds, replies) if k == kind])
            return out

        def words():
            names, which, edges, runs, _ = words_of(data, bounds)
            per_token = replied(WORDS, np.int64, names, runs)[which]
            base = X.row_sums(np.log10((per_token + 1) / (n + v + 1)), edges)
            return np.diff(edges), X.row_sums((per_token > 0).astype(np.int64), edges), base

        def grams(data, bounds):
            names, runs, _ = grams_of(data, bounds)
            cost, so_far = replied(GRAMS, np.float32, names, runs), np.zeros(len(bounds))
            for a, b, key in N.pieces(data, bounds, order):
                found, which = distinct(key)
                sums = np.cumsum(np.append(so_far[-1], cost[np.searchsorted(names, found)][which].astype(np.float64)))
                ends = slice(np.searchsorted(bounds, a), np.searchsorted(bounds, b, side="right"))
                so_far[ends], so_far[-1] = sums[bounds[ends] - a], sums[-1]
            return np.diff(so_far)

        n_tokens, known, base = words()
        model_score = grams(*stream(data, bounds))
        rows_ = len(table)
        return pa.table([
            table.column("doc_id"), table.column("held_out"), pa.array(n_tokens), pa.array(known),
            pa.array(np.full(rows_, n)), pa.array(np.full(rows_, v)), pa.array(base), pa.array(model_score),
        ], names=SCORED_NAMES)

    return packed.groupBy("block").cogroup(told.where("block >= 0").groupBy("block")).applyInArrow(judge, SCORED)


SCORED_NAMES = [c.split()[0] for c in SCORED.split(", ")]
SCORED_KINDS = [pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.float64(), pa.float64()]


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)
