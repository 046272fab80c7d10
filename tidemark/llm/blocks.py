"""Documents packed into compressed blocks, and messages between blocks and hash shards.

Operators that look up something global for every word or window of a text do it in three steps:
a block of documents (a few megabytes) asks each shard once for all its distinct keys, the shard
joins the requests of all blocks, and the block reads the answers. Rows of the shuffles are then
arrays for one (block, shard) pair instead of single keys, and a key costs a block at most one
entry, however often it occurs. Blocks cross the network compressed; both uses of the packed blocks
read the same exchange.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import textops as X

BLOCK_BYTES = 8 << 20
PACKED = "block long, payload binary"


def pack(rows: pa.Table | pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write(rows)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_all()


def squeeze(values: np.ndarray) -> bytes:
    """A compressed integer array; bytes of equal weight are stored together."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def total_bytes(docs: DataFrame, text: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def pack_by_arrival(docs: DataFrame, text: str, partitions: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of consecutive rows of an input split. The number is the task's with a running count, so a repeated
    task gives the same blocks."""

    def step(batches):
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            for part in X.slices(batch, text, block_bytes):
                held.append(part)
                size += part.nbytes if part.num_rows == 1 else int(X.text_bytes(part.column(part.schema.get_field_index(text)))[1][-1])
                if size >= block_bytes // 2:
                    yield _row(block, held)
                    block, held, size = block + 1, [], 0
        if held:
            yield _row(block, held)

    return docs.mapInArrow(step, PACKED).repartition(partitions, "block")


def _row(block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([pack(rows)], pa.binary())], names=["block", "payload"]
    )


def cells(docs: DataFrame, key: str, blocks: int, coarse: int = 1024) -> np.ndarray:
    """Lower bounds of ``blocks`` ranges of a numeric key: quantiles, linear between at most ``coarse`` of them."""
    knots = min(blocks, coarse)
    q = docs.agg(F.percentile_approx(key, [i / knots for i in range(knots + 1)], 10_000)).first()[0]
    if not q or blocks == 1:
        return np.zeros(0, np.int64)
    return np.unique(np.interp(np.arange(1, blocks) / blocks, np.arange(knots + 1) / knots, q).astype(np.int64))


def pack_by_range(docs: DataFrame, key: str, text: str, bounds: np.ndarray, partitions: int, held_bytes: int = 32 << 20) -> DataFrame:
    """Blocks of rows whose key lies in one range, so that a larger block number means larger keys; null keys come
    first. A block may arrive in several rows."""

    def step(batches):
        held, size = [], 0
        for batch in batches:
            for part in X.slices(batch, text, held_bytes // 4):
                held.append(part)
                size += part.nbytes if part.num_rows == 1 else int(X.text_bytes(part.column(part.schema.get_field_index(text)))[1][-1])
                if size >= held_bytes:
                    yield from split(held)
                    held, size = [], 0
        if held:
            yield from split(held)

    def split(parts):
        rows = pa.Table.from_batches(parts).combine_chunks()
        keys = rows.column(rows.schema.get_field_index(key))
        block = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(), side="right")
        order = np.argsort(block, kind="stable")
        rows, block = rows.take(pa.array(order)), block[order]
        edges = np.append(X.run_starts(block), len(block))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield _row(int(block[a]), rows.slice(a, b - a).combine_chunks().to_batches())

    return docs.mapInArrow(step, PACKED).repartition(partitions, "block")


def counts(total: int, per: int) -> int:
    return max(1, math.ceil(total / per))


def shard_runs(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that puts entries of a shard together, and the shards + 1 bounds in it."""
    kind = np.uint16 if shards <= 1 << 16 else np.int64
    order = np.argsort(shard.astype(kind), kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))
