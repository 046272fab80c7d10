"""Substring dedup: words covered by a repeated window of ``size`` words are removed, all but the first occurrence.

Every window of every document gets a Rabin-Karp hash of 64 bits, and its shard comes from a second one with byte values
and bases of its own. Blocks of documents are ranges of ``doc_id``, so (block, place in the block) orders windows
as (doc_id, start) does. A block drops windows that it holds earlier itself and sends each shard the
hash and place of the rest; the shard sorts by hash, and answers every block with the places whose
hash has an earlier block. The block then merges the repeated windows into maximal word intervals
and removes them.

Two different windows are taken for equal only when the 64 bits of one hash and the shard by the other agree. With a
fixed number of windows a shard (``SHARD_WINDOWS``), the expected number of such accidents is about 6e-14 a
window at any size of input.

Defined results: null or empty texts have no words; documents shorter than the window keep all;
documents that share a doc_id are ordered by their text, equal rows by turns, so exactly one of equal
rows keeps its words; a null doc_id sorts before all others; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm import blocks as B, textops as X

WINDOW = 20
SHARD_WINDOWS = 1 << 20
# Bytes a window takes in ordinary text; sets the number of shards, not the result.
BYTES_PER_WINDOW = 6

REMOVED = "n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept_text string"


class Block:
    """The documents of one block in order, their words and windows."""

    def __init__(self, payloads: list[bytes], size: int, shards: int = 0):
        rows = pa.concat_tables([B.unpack(p) for p in payloads])
        self.rows = rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        # Arrow sorts nulls last
        nulls = rows.column("doc_id").null_count
        if nulls:
            self.rows = rows = pa.concat_tables([rows.slice(len(rows) - nulls), rows.slice(0, len(rows) - nulls)]).combine_chunks()
        column = rows.column("text").combine_chunks()
        self.data, self.bounds = X.text_bytes(column)
        self.starts, self.ends, self.word_bounds = X.word_spans(self.data, self.bounds, X.NOT_SPACE)
        words = X.word_hashes(self.data, self.starts, self.ends)
        hashes = X.window_hashes(words, size)
        place = np.flatnonzero(X.window_mask(self.word_bounds, size))
        hashes = hashes[place]
        order = np.argsort(hashes, kind="stable")
        first = np.zeros(len(order), bool)
        first[order[X.run_starts(hashes[order])]] = True
        self.repeated_here = place[~first]
        self.place, self.hashes = place[first], hashes[first]
        if shards:
            words = X.word_hashes(self.data, self.starts, self.ends, other=True)
            self.shard = (X.window_hashes(words, size, other=True)[self.place] % X.U64(shards)).astype(np.int64)


def removed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WINDOW,
    block_bytes: int = B.BLOCK_BYTES, digest: bool = False,
) -> DataFrame:
    """One row per document: word counts, the removed word intervals (end exclusive) and the kept text (words
    joined by one space), or with ``digest`` the SHA-256 of that text."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    total = B.total_bytes(docs, "text")
    n_blocks = B.counts(total, block_bytes)
    shards = B.counts(total, SHARD_WINDOWS * BYTES_PER_WINDOW)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), B.counts(total, 32 << 20))
    packed = B.pack_by_range(docs, "doc_id", "text", B.cells(docs, "doc_id", n_blocks), partitions)

    def ask(key, table):
        block = Block(table.column("payload").to_pylist(), size, shards)
        order, edges = B.shard_runs(block.shard, shards)
        rows = [
            (s, key[0].as_py(), block.hashes[order[a:b]].tobytes(), B.squeeze(np.diff(block.place[order[a:b]], prepend=0).astype(np.uint32)))
            for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a
        ]
        cols = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["shard", "block", "hashes", "places"])

    def answer(key, table):
        blocks = table.column("block").to_numpy()
        order = np.argsort(blocks)
        hashes = [np.frombuffer(table.column("hashes")[int(i)].as_py(), X.U64) for i in order]
        hashes = np.concatenate(hashes)
        by_hash = np.argsort(hashes, kind="stable")  # a block sends a hash once, and blocks are in order
        later = np.ones(len(hashes), bool)
        later[by_hash[X.run_starts(hashes[by_hash])]] = False
        rows, at = [], 0
        for i in order:
            places = np.cumsum(B.unsqueeze(table.column("places")[int(i)].as_py(), np.uint32).astype(np.int64))
            mine = later[at : at + len(places)]
            at += len(places)
            if mine.any():
                rows.append((int(blocks[i]), B.squeeze(np.diff(places[mine], prepend=0).astype(np.uint32))))
        cols = list(zip(*rows)) if rows else [[]] * 2
        return pa.table([pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.binary())], names=["block", "places"])

    def remove(key, packed_rows, answers):
        if not packed_rows.num_rows:
            return _result([], digest)
        block = Block(packed_rows.column("payload").to_pylist(), size)
        told = [np.cumsum(B.unsqueeze(p, np.uint32).astype(np.int64)) for p in answers.column("places").to_pylist()]
        windows = np.concatenate([block.repeated_here, *told])
        gone = X.covered(windows, size, len(block.starts)) if len(windows) else np.zeros(len(block.starts), bool)
        return _rows(block, gone, digest)

    asked = packed.groupBy("block").applyInArrow(ask, "shard long, block long, hashes binary, places binary")
    told = asked.groupBy("shard").applyInArrow(answer, "block long, places binary")
    names = REMOVED.replace("kept_text", "kept_sha256") if digest else REMOVED
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *T._parse_datatype_string(names).fields])
    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(remove, schema)


def _rows(block: Block, gone: np.ndarray, digest: bool) -> pa.Table:
    out, bounds = X.joined_words(block.data, block.bounds, block.starts, block.ends, ~gone)
    rows = []
    ids = block.rows.column("doc_id").to_pylist()
    removed_before = np.concatenate([[0], np.cumsum(gone)])
    for k, doc in enumerate(ids):
        a, b = block.word_bounds[k], block.word_bounds[k + 1]
        n_removed = int(removed_before[b] - removed_before[a])
        spans = []
        if n_removed:
            inner = np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]]))
            spans = [{"first": int(x), "last": int(y)} for x, y in zip(np.flatnonzero(inner == 1), np.flatnonzero(inner == -1))]
        kept = out[bounds[k] : max(bounds[k], bounds[k + 1] - 1)].tobytes()
        rows.append((doc, int(b - a), n_removed, spans, hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
    return _result(rows, digest)


def _result(rows: list[tuple], digest: bool) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.string()]
    names = ["doc_id", "n_words", "n_removed", "spans", "kept_sha256" if digest else "kept_text"]
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)
