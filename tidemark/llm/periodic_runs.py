"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that no neighbouring
word extends and that is at least ``max(least, exponent * q)`` words long.

A task reads its documents in slices of a few megabytes and makes one Re-Pair grammar for a slice: word ids are
exact dictionary codes, and rounds replace pairs that occur twice or more by nonterminals, pairs of a higher
class of counts (powers of two) first and in a fixed random order inside a class, until no pair repeats; pairs
never cross documents. What is left of each document is halved into a balanced tree of rules that are used once.

A run inside a nonterminal's expansion either lies in one of its two halves or crosses the boundary between
them, so each boundary is searched once, on the nonterminal's first occurrence: a run of exponent 4 or more has
two periods on one side of the boundary, so the candidate periods are the squares that end or begin there; they
and their extensions are found by range hashes and every result is checked word by word. Runs are translated to
all places where the nonterminal was derived, and intervals of one period that overlap by a period or lie in each
other are merged into maximal ones.

Memory is linear in the words of a slice, about 200 bytes each; a longer text is a slice of its own.

Defined results: null and empty texts have no words and no runs; rows are handled one by one, so repeated rows
repeat their result, null and repeated ids are passed through; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm import textops as X

LEAST = 6
EXPONENT = 4
CHUNK = 1 << 21
PRIMES = (2147483647, 2147483629)
BASES = (1190494759, 2089106249)
RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"


class Ranges:
    """Equality of ranges of one sequence by polynomial hashes modulo two primes."""

    def __init__(self, ids: np.ndarray):
        self.sums, self.powers = [], []
        for p, b in zip(PRIMES, BASES):
            up = np.ones(1, np.int64)
            step = b
            while len(up) <= len(ids):
                up = np.concatenate([up, up * step % p])
                step = step * step % p
            values = (ids * 1000003 + 12345) % p * up[: len(ids)] % p
            sums = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(values, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(up)

    def equal(self, a: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether [a, a + size) equals [a + q, a + q + size)."""
        same = np.ones(len(a), bool)
        for s, up, p in zip(self.sums, self.powers, PRIMES):
            same &= (s[a + size] - s[a]) * up[q] % p == (s[a + q + size] - s[a + q]) % p
        return same

    def extend(self, a: np.ndarray, q: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The greatest size up to ``most`` for which the ranges that start (or, ``back``, end) at a and a + q agree."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            good = self.equal(a - mid if back else a, q, mid)
            low, high = np.where(good, mid, low), np.where(good, high, mid - 1)
        return low


def crossing(ids: np.ndarray, ranges: Ranges, lo, mid, hi, least: int = LEAST, exponent: int = EXPONENT):
    """Runs, clipped to [lo, hi), that cross the boundary ``mid`` of each rule: (rule, start, end, period)."""
    big = np.flatnonzero(hi - lo >= least)
    longest = (hi[big] - lo[big]) // exponent
    out = []
    for right in (True, False):
        room = np.minimum(longest, (hi[big] - mid[big] if right else mid[big] - lo[big]) // 2)
        rules, room = big[room > 0], room[room > 0]
        ends = np.cumsum(room)
        at = 0
        while at < len(rules):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
            out += _squares(ids, ranges, np.repeat(rules[at:stop], room[at:stop]), X.ranges(np.ones(stop - at, np.int64), room[at:stop]), mid, right)
            at = stop
    rule, anchor, q = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*out) if out else [[], [], []]))
    end = anchor + q + ranges.extend(anchor, q, hi[rule] - anchor - q, False)
    start = anchor - ranges.extend(anchor, q, anchor - lo[rule], True)
    good = (start < mid[rule]) & (end > mid[rule]) & (end - start >= np.maximum(least, exponent * q))
    rule, start, end, q = rule[good], start[good], end[good], q[good]
    order = np.lexsort((q, end, start, rule))
    rule, start, end, q = rule[order], start[order], end[order], q[order]
    first = np.ones(len(rule), bool)  # equal stretches: the smallest period
    first[1:] = (rule[1:] != rule[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    rule, start, end, q = rule[first], start[first], end[first], q[first]
    size = end - start - q
    places = X.ranges(start, size)
    if (ids[places] != ids[places + np.repeat(q, size)]).any():
        raise ArithmeticError("two different word ranges have one hash; change BASES")
    return rule, start, end, q


def _squares(ids, ranges, rule, q, mid, right):
    """Of the (rule, period) pairs those with two equal blocks right or left of the boundary, as (rule, anchor, period)."""
    m = mid[rule]
    a = m if right else m - 2 * q
    same = ids[a] == ids[a + q]
    rule, q, a = rule[same], q[same], a[same]
    same = ids[a + q - 1] == ids[a + 2 * q - 1]
    rule, q, a = rule[same], q[same], a[same]
    same = ranges.equal(a, q, q)
    return [(rule[same], a[same], q[same])]


def slice_runs(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST, exponent: int = EXPONENT):
    """Maximal runs (start, end, period) in the word ids of documents with the given bounds, ordered by start and period."""
    if exponent < 4:
        raise ValueError("squares beside a boundary are sure for exponents from 4 on")
    ranges = Ranges(ids)
    found = [_rules(ids, ranges, places, least, exponent) for places in grammar(ids, bounds)]
    start, end, q = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*found) if found else [[], [], []]))
    return merged(start, end, q, len(ids))


def _rules(ids, ranges, places, least, exponent):
    """Runs of the rules of one round at all their places; ``places``: rule number, lo, mid and hi of every occurrence."""
    rule, lo, mid, hi = places
    order = np.argsort(rule, kind="stable")
    first = np.append(X.run_starts(rule[order]), len(rule))
    one = order[first[:-1]]
    at, start, end, q = crossing(ids, ranges, lo[one], mid[one], hi[one], least, exponent)
    copies = np.diff(first)[at]
    shift = lo[order[X.ranges(first[:-1][at], copies)]] - np.repeat(lo[one][at], copies)
    return np.repeat(start, copies) + shift, np.repeat(end, copies) + shift, np.repeat(q, copies)


def grammar(ids: np.ndarray, bounds: np.ndarray):
    """Rounds of a Re-Pair grammar and of the halving of what is left: (rule, lo, mid, hi) of every occurrence of the
    rules made in the round."""
    sym, pos = ids.astype(np.int64), np.arange(len(ids) + 1)
    last = np.zeros(len(ids), bool)
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    live = ~last  # the pair that starts here may occur twice
    fresh = int(ids.max()) + 1 if len(ids) else 0

    def replaced(at, rule):
        nonlocal sym, pos, last, live
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym[at], last[at] = rule, last[at + 1]
        live[at] = True
        live[at[at > 0] - 1] = True
        live &= ~last
        sym, last, live, pos = sym[keep], last[keep], live[keep], pos[np.append(keep, True)]

    while True:
        at = np.flatnonzero(live)
        code, names = pd.factorize(sym[at] << 32 | sym[at + 1])
        count = np.bincount(code, minlength=len(names))
        often = count[code] >= 2
        live[at[~often]] = False
        at, code = at[often], code[often]
        if not len(at):
            break
        shuffled = np.random.default_rng(len(names)).permutation(len(names))
        rank = np.zeros(len(sym) + 1, np.int64)  # the last entry stands left of the first
        rank[at] = np.frexp(count[code])[1] * len(names) + shuffled[code]
        peak = (rank[at] >= rank[at - 1]) & (rank[at] >= rank[at + 1])
        # occurrences that overlap are of one pair of equal symbols; every other one counts
        again = np.zeros(len(at), bool)
        again[1:] = (at[1:] == at[:-1] + 1) & (code[1:] == code[:-1])
        head = np.maximum.accumulate(np.where(again, 0, np.arange(len(at))))
        peak &= (np.arange(len(at)) - head) % 2 == 0
        at, code = at[peak], code[peak]
        yield code, pos[at], pos[at + 1], pos[at + 2]
        replaced(at, fresh + code)
        fresh += len(names)
    while not last.all():
        index = np.arange(len(last))
        begin = np.maximum.accumulate(np.where(np.append(True, last[:-1]), index, 0))
        at = index[((index - begin) % 2 == 0) & ~last]
        yield np.arange(len(at)), pos[at], pos[at + 1], pos[at + 2]
        replaced(at, 0)


def merged(start, end, q, total: int):
    """Unions of intervals of one period that overlap by a period or more, ordered by start and period."""
    order = np.lexsort((start, q))
    start, end, q = start[order], end[order], q[order]
    base = q * (total + 1)
    reach = np.maximum.accumulate(end + base)
    new = np.ones(len(q), bool)
    new[1:] = start[1:] + base[1:] > reach[:-1] - q[1:]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(q)) - 1 if len(heads) else heads
    start, end, q = start[heads], reach[tails] - base[tails], q[heads]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.ones(len(q), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[first], end[first], q[first]


def word_ids(data: np.ndarray, bounds: np.ndarray):
    """Starts, ends and row bounds of words, and an exact id of each (equal words, equal ids)."""
    starts, ends, word_bounds = X.word_spans(data, bounds, X.NOT_SPACE)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    body = np.ascontiguousarray(data[X.NOT_SPACE[data]])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return starts, ends, word_bounds, words.dictionary_encode().indices.to_numpy().astype(np.int64)


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """One row per document: doc_id, n_words, its runs by start and period, and ``collapsed``: the words that no run
    contains after its first period, joined by one space."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def step(batches):
        for batch in batches:
            for part in X.slices(batch, "text"):
                yield _digest(part, least, exponent)

    return rows.mapInArrow(step, SCHEMA)


def _digest(part: pa.RecordBatch, least: int, exponent: int) -> pa.RecordBatch:
    data, bounds = X.text_bytes(part.column(1))
    starts, ends, word_bounds, ids = word_ids(data, bounds)
    start, end, q = slice_runs(ids, word_bounds, least, exponent)
    drop = np.zeros(len(ids) + 1, np.int64)
    np.add.at(drop, start + q, 1)
    np.add.at(drop, end, -1)
    kept = np.cumsum(drop[:-1]) == 0
    out, out_bounds = X.joined_words(data, bounds, starts, ends, kept)
    filled = np.diff(out_bounds) > 0  # each kept word is followed by a space; the last one of a row goes
    body = np.delete(out, out_bounds[1:][filled] - 1)
    cuts = (out_bounds - np.append(0, np.cumsum(filled))).astype(np.int64)
    text = pa.Array.from_buffers(pa.large_string(), part.num_rows, [None, pa.py_buffer(cuts), pa.py_buffer(body)])
    runs = pa.StructArray.from_arrays(
        [pa.array(start - word_bounds[np.searchsorted(word_bounds, start, side="right") - 1]), pa.array(end - start), pa.array(q)],
        names=["start", "length", "period"],
    )
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, word_bounds).astype(np.int32)), runs)
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(np.diff(word_bounds).astype(np.int64)), lists, text.cast(pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest (ties: smallest start, then period), and hashes of all runs and of the kept words."""
    longest = F.reduce(
        "runs", F.lit(None).cast(RUN), lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best)
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    found = found.withColumn("top", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) in which a tenth of the documents is made periodic, by a rule on the hash of doc_id: with
    h = crc32(doc_id), g = h // 10, n words, and h % 10 = 0, words from a = g % n on repeat with the period
    1 + (n - a) // (3 + g % 8). A null doc_id is left as it is."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), h.alias("h"))
    none = F.array().cast("array<string>")
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = chosen.select("doc_id", "text", F.expr("h div 10").alias("g"), F.coalesce(words, none).alias("words"))
    cut = cut.select("*", F.size("words").alias("n")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    cut = cut.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    body: Column = F.expr(
        "array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')"
    )
    return cut.select("doc_id", F.when(F.col("n") > 0, body).otherwise(F.col("text")).alias("text"))
