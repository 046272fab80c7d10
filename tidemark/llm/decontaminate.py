"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of ``window`` consecutive words of every benchmark item (an item with
fewer words, but not none, is one pattern). Words are the alphabet: a block is two neighbouring
words. A shift table says, per hashed block, how far a search position may move without passing the
end of a pattern; the common block of two words that occurs in no pattern moves it by nearly a whole
window. A position with shift 0 looks up the patterns whose last block has the same hash, compares
all word hashes, and confirms by comparing the bytes. Patterns of one length share a table, so a
short item does not shorten the shifts of long ones. Many document stretches move in lockstep, as
numpy arrays.

The search is a map over documents: no shuffle and no join of them. Patterns are made by Spark, distinct, and dealt into chunks
of about ``CHUNK_WINDOWS`` windows in the shared folder; the driver and a task hold one chunk at a time. Each further
chunk is one more map over the documents, whose hits so far are settled in between; all benchmarks known today are one chunk.

Defined results: null or empty texts have no words and are never hit; items without words have no
windows; a null item id counts as the item ''; repeated item ids count once; repeated documents are
each judged alone; other input columns are ignored by :func:`contamination` and kept by
:func:`drop_contaminated`. A document is contaminated when it has a hit word and ``share`` times the
hit words reach its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm import textops as X
from tidemark.session import discard, scratch_path, settle

WINDOW = 13
SHARE = 20  # contaminated from one hit word in so many
CHUNK_WINDOWS = 100_000
LANE = 512
SLOT_BITS = 18

RESULT = (
    "n_words long, n_hit long, n_items long, items array<string>, "
    "spans array<struct<first:long,last:long>>, contaminated boolean"
)


def _words(data: np.ndarray, bounds: np.ndarray):
    data = X.LOWER[data]
    starts, ends, word_bounds = X.word_spans(data, bounds, X.ALNUM)
    return data, starts, ends, word_bounds, X.word_hashes(data, starts, ends)


class Patterns:
    """Shift and bucket tables for patterns of one length."""

    def __init__(self, hashes: np.ndarray, texts: list[bytes], items: list[str]):
        self.hashes, self.texts, self.items = hashes, texts, items
        self.size = m = hashes.shape[1]
        self.block = b = min(2, m)
        shift = np.full(1 << SLOT_BITS, m - b + 1, np.int64)
        for end in range(b, m + 1):
            slots = self.slots(hashes[:, end - b], hashes[:, end - 1])
            np.minimum.at(shift, slots, m - end)
        self.shift = shift
        last = self.slots(hashes[:, m - b], hashes[:, m - 1])
        self.order = np.argsort(last, kind="stable")
        self.first = np.searchsorted(last[self.order], np.arange((1 << SLOT_BITS) + 1))

    @staticmethod
    def slots(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (X.mix(one * X.U64(3) + two) >> X.U64(64 - SLOT_BITS)).astype(np.int64)

    def ends(self, words: np.ndarray, word_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions at which a pattern may end (shift 0), and the block slot there."""
        m, b = self.size, self.block
        counts = np.diff(word_bounds)
        lanes = np.maximum(0, -(-(counts - m + 1) // LANE))
        doc = np.repeat(np.arange(len(counts)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = word_bounds[doc] + nth * LANE + m - 1
        limit = np.minimum(at + LANE, word_bounds[doc + 1])
        found, slots = [], []
        while len(at):
            slot = self.slots(words[at - b + 1], words[at])
            step = self.shift[slot]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
                slots.append(slot[zero])
            at = at + np.maximum(step, 1)
            live = at < limit
            at, limit = at[live], limit[live]
        none = np.zeros(0, np.int64)
        return (np.concatenate(found), np.concatenate(slots)) if found else (none, none)

    def occurrences(self, words: np.ndarray, word_bounds: np.ndarray, text) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern number of every confirmed occurrence; ``text(first, count)`` gives bytes."""
        at, slot = self.ends(words, word_bounds)
        begin, counts = self.first[slot], self.first[slot + 1] - self.first[slot]
        pattern = self.order[X.ranges(begin, counts)]
        first = np.repeat(at, counts) - self.size + 1
        same = np.ones(len(first), bool)
        for k in range(self.size):
            same[same] = words[first[same] + k] == self.hashes[pattern[same], k]
        first, pattern = first[same], pattern[same]
        sure = np.fromiter(
            (text(i, self.size) == self.texts[p] for i, p in zip(first.tolist(), pattern.tolist())), bool, len(first)
        )
        return first[sure], pattern[sure]


def item_windows(item: str, text: str | None, window: int = WINDOW) -> list[tuple[int, tuple, bytes]]:
    """(length, word hashes, normalised bytes) of the distinct windows of one item."""
    raw = (text or "").encode()
    data, starts, ends, _, hashes = _words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    size = min(window, len(hashes))
    if not size:
        return []
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    out = {}
    for i in range(len(words) - size + 1):
        out[b" ".join(words[i : i + size])] = (size, tuple(hashes[i : i + size].tolist()))
    return [(size, key, raw) for raw, (size, key) in out.items()]


def pattern_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> tuple[DataFrame, int]:
    """The distinct windows of all items, (item, size, key, raw, chunk), stored, and the number of chunks."""
    chosen = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text"))

    def step(batches):
        for batch in batches:
            for item, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(item, size, np.array(key, X.U64).tobytes(), raw) for size, key, raw in item_windows(item, body, window)]
                if rows:
                    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=["item", "size", "key", "raw"])

    windows = settle(chosen.mapInArrow(step, "item string, size int, key binary, raw binary").distinct(), "patterns")
    chunks = max(1, -(-windows.count() // CHUNK_WINDOWS))
    return windows.withColumn("chunk", F.pmod(F.xxhash64("item", "raw"), F.lit(chunks))), chunks


def pattern_table(windows: DataFrame, chunk: int) -> list[Patterns]:
    """The tables of one chunk, one for each window length."""
    rows: dict[int, list] = {}
    for r in windows.where(F.col("chunk") == chunk).toLocalIterator():
        rows.setdefault(r["size"], []).append((np.frombuffer(r["key"], X.U64), bytes(r["raw"]), r["item"]))
    for group in rows.values():
        group.sort(key=lambda x: (x[1], x[2]))
    return [Patterns(np.array([r[0] for r in group], X.U64), [r[1] for r in group], [r[2] for r in group]) for _, group in sorted(rows.items())]


def _scan(part: pa.RecordBatch, column: str, groups: list[Patterns]):
    """Per row of a slice: word count, new hit ranges (first word, end) and new item ids."""
    data, bounds = X.text_bytes(part.column(part.schema.get_field_index(column)))
    data, starts, ends, word_bounds, hashes = _words(data, bounds)
    n = part.num_rows
    ranges: list[list] = [[] for _ in range(n)]
    items: list[set] = [set() for _ in range(n)]
    joined = None

    def text(first: int, count: int) -> bytes:
        nonlocal joined
        if joined is None:
            out, _ = X.joined_words(data, bounds, starts, ends, np.ones(len(starts), bool))
            joined = (out, np.concatenate([[0], np.cumsum(ends - starts + 1)]))
        return joined[0][joined[1][first] : joined[1][first + count] - 1].tobytes()

    for group in groups:
        first, pattern = group.occurrences(hashes, word_bounds, text)
        if not len(first):
            continue
        row = np.searchsorted(word_bounds, first, side="right") - 1
        for r, f, p in zip(row.tolist(), (first - word_bounds[row]).tolist(), pattern.tolist()):
            ranges[r].append((f, f + group.size))
            items[r].add(group.items[p])
    return np.diff(word_bounds), ranges, items


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_STATE = pa.struct([("ranges", pa.binary()), ("items", pa.list_(pa.string())), ("n_words", pa.int64())])
_STATE_SQL = "struct<ranges:binary,items:array<string>,n_words:long>"


def _search(docs: DataFrame, column: str, patterns: tuple[DataFrame, int], finish, schema: T.StructType) -> DataFrame:
    """One map over the documents per chunk. All but the last add the hits so far as a column and are settled; the last
    calls ``finish(rows, states)`` and returns its batch."""
    windows, chunks = patterns
    state, names, spark = X.fresh("__hits", docs.columns), docs.columns, docs.sparkSession
    kept = T.StructType([*docs.schema.fields, T.StructField(state, T._parse_datatype_string(_STATE_SQL))])
    path = None
    for k in range(chunks):
        groups, last = pattern_table(windows, k), k == chunks - 1

        def step(batches, groups=groups, first=k == 0, last=last):
            for batch in batches:
                for part in X.slices(batch, column):
                    counts, ranges, items = _scan(part, column, groups)
                    before = [None] * part.num_rows if first else part.column(part.num_columns - 1).to_pylist()
                    states = []
                    for n, new, ids, old in zip(counts.tolist(), ranges, items, before):
                        if old:
                            new = new + [tuple(r) for r in np.frombuffer(old["ranges"], np.int64).reshape(-1, 2).tolist()]
                            ids = ids | set(old["items"])
                        merged = np.array(_merged(new), np.int64).tobytes()
                        states.append({"ranges": merged, "items": sorted(ids), "n_words": n})
                    rows = pa.RecordBatch.from_arrays(part.columns[: len(names)], names=names)
                    if last:
                        yield finish(rows, states)
                    else:
                        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(states, _STATE)], names=[*names, state])

        docs = docs.mapInArrow(step, schema if last else kept)
        if not last:
            before, path = path, scratch_path(spark, "hits")
            docs = settle(docs, "hits", path)
            if before:
                discard(spark, before)
    return docs


def _judged(state: dict, share: int) -> tuple[int, list[tuple[int, int]], bool]:
    spans = [tuple(r) for r in np.frombuffer(state["ranges"], np.int64).reshape(-1, 2).tolist()]
    hit = sum(b - a for a, b in spans)
    return hit, spans, hit > 0 and share * hit >= state["n_words"]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = SHARE,
) -> DataFrame:
    """One row per document: ``doc_id``, counts, ids of items found, hit word spans (end exclusive), verdict."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()),
             pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.bool_()]
    schema = T.StructType([named.schema["doc_id"], *T._parse_datatype_string(RESULT).fields])
    names = schema.names

    def finish(rows, states):
        out = []
        for state in states:
            hit, spans, bad = _judged(state, share)
            shown = [{"first": a, "last": b} for a, b in spans]
            out.append((state["n_words"], hit, len(state["items"]), state["items"], shown, bad))
        columns = list(zip(*out)) if out else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [rows.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]], names=names
        )

    return _search(named, "text", pattern_windows(benchmark, item_id, item_text, window), finish, schema)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = SHARE,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""

    def finish(rows, states):
        return rows.filter(pa.array([not _judged(s, share)[2] for s in states], pa.bool_()))

    return _search(docs, text, pattern_windows(benchmark, item_id, item_text, window), finish, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The result columns with the item ids folded to one hash."""
    joined = F.concat_ws(",", F.array_sort("items"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(joined, 256).alias("items_sha256"), "contaminated"
    )
