"""Byte n-gram counts, merged in shards of the two latest context bytes.

A gram of order k is a symbol with the k bytes before it. Its key holds the symbol in the highest
byte, then the context from the latest byte to the oldest, so that dropping the lowest byte gives
the gram of order k - 1 and sorted keys stay sorted. A shard holds whole contexts of order 2 and
more; grams of order 0 and 1 are at most 65,792 sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import blocks as B, textops as X

PAD = 0x0A
COUNTED = "grp string, shard long, keys binary, counts binary"
SHARD_BYTES = 64 << 20
HELD_KEYS = 4_000_000
PIECE = 1 << 20

Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def keys(data: np.ndarray, bounds: np.ndarray, order: int) -> np.ndarray:
    """The key of every byte of every row; a row starts after ``order`` pad bytes."""
    lengths = np.diff(bounds)
    padded = np.full(len(data) + order * len(lengths), PAD, np.uint8)
    place = X.ranges(bounds[:-1] + order * np.arange(1, len(lengths) + 1), lengths)
    padded[place] = data
    key = np.zeros(len(padded), np.uint64)
    for j in range(order + 1):  # a shifted slice for each byte of the context
        key[j:] |= padded[: len(padded) - j].astype(np.uint64) << np.uint64(8 * (order - j))
    return key[place]


def pieces(data: np.ndarray, bounds: np.ndarray, order: int, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray]]:
    """(low, high, keys of the bytes between) for runs of ``size`` bytes, which may cut rows."""
    for low in range(0, len(data), size):
        high = min(low + size, len(data))
        first = int(np.searchsorted(bounds, low, side="right")) - 1
        last = int(np.searchsorted(bounds, high, side="left"))
        start = max(int(bounds[first]), low - order)  # a cut row lends the context of its next byte
        edges = np.clip(bounds[first : last + 1], start, high) - start
        yield low, high, keys(data[start:high], edges, order)[low - start :]


def distinct(data: np.ndarray, bounds: np.ndarray, order: int, size: int = PIECE) -> np.ndarray:
    """The distinct keys of all rows, in order."""
    parts = [np.zeros(0, np.uint64)]
    for _, _, key in pieces(data, bounds, order, size):
        key.sort()
        parts.append(key[X.run_starts(key)])
    found = np.sort(np.concatenate(parts))
    return found[X.run_starts(found)]


def context(key: np.ndarray, k: int) -> np.ndarray:
    return key & np.uint64((1 << 8 * k) - 1)


def summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = X.run_starts(key)
    return key[at], np.add.reduceat(count[order], at) if len(at) else count[:0]


def lower(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts one order below; keys stay in order."""
    short = key >> np.uint64(8)
    at = X.run_starts(short)
    return short[at], np.add.reduceat(count, at) if len(at) else count[:0]


def shard_of(key: np.ndarray, order: int, shards: int) -> np.ndarray:
    kind = np.uint16 if shards <= 1 << 16 else np.int64
    owner = (X.mix(np.arange(1 << 16, dtype=np.uint64), 11) % np.uint64(shards)).astype(kind)
    return owner[(key >> np.uint64(8 * (order - 2))).astype(np.uint16)]  # the two latest context bytes


def counts(docs: DataFrame, group: str, text: str, order: int, shards: int, symbols: Symbols | None = None) -> DataFrame:
    """Gram counts per group and shard, one row each. ``symbols`` may rewrite the bytes and bounds of the rows."""

    def step(batches):
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            for part in X.slices(batch, text, 2 << 20):
                data, bounds = X.text_bytes(part.column(part.schema.get_field_index(text)))
                if symbols:
                    data, bounds = symbols(data, bounds)
                key = keys(data, bounds, order)
                names = part.column(part.schema.get_field_index(group)).to_pylist()
                distinct = sorted(set(names))
                code = {name: i for i, name in enumerate(distinct)}
                owner = np.repeat(np.array([code[x] for x in names], np.int64), np.diff(bounds))
                for i, name in enumerate(distinct):
                    mine = np.sort(key[owner == i] if len(distinct) > 1 else key)
                    at = X.run_starts(mine)
                    mine, count = mine[at], np.diff(np.append(at, len(mine))).astype(np.uint32)
                    order_, edges = B.shard_runs(shard_of(mine, order, shards), shards)
                    held.setdefault(name, []).append((mine[order_], count[order_], edges))
                    size += len(at)
                if size > HELD_KEYS:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    def emit(held):
        for name, parts in sorted(held.items()):
            rows = []
            for s in range(shards):
                mine = [(key[e[s] : e[s + 1]], count[e[s] : e[s + 1]]) for key, count, e in parts if e[s + 1] > e[s]]
                if mine:
                    key, count = summed(*(np.concatenate(x) for x in zip(*mine)))
                    rows.append((name, s, B.squeeze(key), B.squeeze(count.astype(np.uint32))))
            if rows:
                yield batch_of(rows, pa.uint32())

    def batch_of(rows, _):
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["grp", "shard", "keys", "counts"]
        )

    def merge(_, table):
        key = np.concatenate([B.unsqueeze(x, np.uint64) for x in table.column("keys").to_pylist()])
        count = np.concatenate([B.unsqueeze(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        key, count = summed(key, count)
        return pa.table({
            "grp": table.column("grp").slice(0, 1), "shard": table.column("shard").slice(0, 1),
            "keys": pa.array([B.squeeze(key)], pa.binary()), "counts": pa.array([B.squeeze(count)], pa.binary()),
        })

    return docs.mapInArrow(step, COUNTED).groupBy("grp", "shard").applyInArrow(merge, COUNTED)


def frequent(counted: DataFrame, order: int, least: int) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
    """Grams whose context occurs ``least`` times or more in its group, by group and order, with all grams of order 0
    and 1. They come to the driver: for counts of a sample of bounded size."""

    def step(batches):
        for batch in batches:
            for name, raw_keys, raw_counts in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                key, count = B.unsqueeze(raw_keys, np.uint64), B.unsqueeze(raw_counts, np.int64)
                for k in range(order, -1, -1):
                    kept = key, count
                    if k >= 2:
                        _, which = np.unique(context(key, k), return_inverse=True)
                        often = np.bincount(which, count)[which] >= least
                        kept = key[often], count[often]
                    if len(kept[0]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name]), pa.array([k], pa.int32()), pa.array([B.squeeze(kept[0])], pa.binary()),
                             pa.array([B.squeeze(kept[1])], pa.binary())], names=["grp", "k", "keys", "counts"])
                    if k:
                        key, count = lower(key, count)

    chosen = counted.select("grp", "keys", "counts").mapInArrow(step, "grp string, k int, keys binary, counts binary")
    parts: dict[tuple[str, int], list] = {}
    for name, k, raw_keys, raw_counts in chosen.toLocalIterator():
        parts.setdefault((name, k), []).append((B.unsqueeze(raw_keys, np.uint64), B.unsqueeze(raw_counts, np.int64)))
    return {at: summed(*[np.concatenate(x) for x in zip(*found)]) for at, found in parts.items()}
