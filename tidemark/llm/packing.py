"""Sequence packing along a space-filling curve.

Documents become token ids, and the mean over its ids of pseudo-random signs of each id (a hashed
bag of tokens, projected to ``DIMS`` dimensions) gives a document a point. Points are laid on a
Hilbert curve; documents are range-sorted by curve position (then doc_id), and the stream of all
ids in this order is cut every ``LENGTH`` ids. Neighbours on the curve therefore share sequences, and
only the very last sequence of the corpus can need padding.

Tokenised documents are written once to the shared folder. The order is found on narrow rows (key,
id, length): a range sort, lengths summed per sorted partition, then per row. Ids move once more, to
the task of their place in the stream, where pieces are cut.

Defined results: a null text is empty and consists of the end id alone; documents that share a doc_id
are told apart by a number given while tokenising, so equal rows take neighbouring places; a null
doc_id sorts first; an empty table gives no pieces; other columns are ignored. Text that looks like
the vocabulary's special token becomes that token, as the tokenizer defines.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import textops as X
from tidemark.session import settle

LENGTH = 2048
END = 1
DIMS, BITS = 4, 12
SPREAD = 3.0
SPECIAL = "<|endoftext|>"
TOKENIZED = "nr long, doc_id long, curve long, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary() -> tuple[str, str]:
    """Paths of the tokenizer file and of the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoders(json_path: str, ranks_path: str | None):
    """A function from a text to its ids. With ranks the faster library encodes; texts that name the special token,
    and those that the faster one refuses, go through the tokenizer itself."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)

    def exact(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    if not ranks_path:
        return exact
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return exact(text)
        try:
            return np.array(fast.encode_ordinary(text), np.uint32)
        except Exception:  # the pattern engine's stack on odd input; the panic has no class of its own
            return exact(text)

    return encode


@lru_cache(maxsize=2)
def signs(size: int, dims: int) -> np.ndarray:
    bits = X.mix(np.arange(size * dims, dtype=np.uint64), 3)
    return (bits & np.uint64(1)).astype(np.float64).reshape(size, dims) * 2 - 1


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points of shape (n, dims), by transposing Gray-coded axes."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) > 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_position(ids: list[np.ndarray], dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Curve positions of documents given by their ids (never empty)."""
    table = signs(1 << 16, dims)
    flat = np.concatenate(ids)
    lengths = np.array([len(i) for i in ids])
    sums = np.add.reduceat(table[flat & np.uint32(0xFFFF)], np.cumsum(lengths) - lengths, axis=0)
    # signs are even coins: a mean of n of them varies by 1/sqrt(n), shared words make it vary more
    z = np.clip(sums / lengths[:, None] * SPREAD, -1, 1)
    return hilbert(np.minimum(((z + 1) / 2 * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def tokenize(docs: DataFrame, doc_id: str, text: str, json_path: str, ranks_path: str | None) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def step(batches):
        encode = encoders(json_path, ranks_path)
        nr = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in X.slices(batch, "text"):
                ids = [np.append(encode(t), np.uint32(END)) for t in part.column(1).to_pylist()]
                raw = pa.array([(i.astype(np.uint16) if i.max() < 1 << 16 else i).tobytes() for i in ids], pa.binary())
                n = np.array([len(i) for i in ids])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nr + np.arange(len(ids))), part.column(0), pa.array(curve_position(ids)), pa.array(n), raw],
                    names=["nr", "doc_id", "curve", "n", "ids"],
                )
                nr += len(ids)

    return rows.mapInArrow(step, TOKENIZED)


def starts(tokens: DataFrame) -> DataFrame:
    """nr and first place in the stream of every document."""
    spark = tokens.sparkSession
    narrow = tokens.select("nr", "doc_id", "curve", "n")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = narrow.repartitionByRange(parts, "curve", F.col("doc_id").asc_nulls_first(), "nr")
    ordered = settle(ordered.withColumn("part", F.spark_partition_id()), "packing-order")
    # one row per partition
    before = ordered.groupBy("part").agg(F.sum("n").alias("total"))
    before = before.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    own = Window.partitionBy("part").orderBy("curve", F.col("doc_id").asc_nulls_first(), "nr")
    running = ordered.withColumn("own", F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    return running.join(F.broadcast(before), "part").select("nr", (F.col("before") + F.col("own")).alias("at"))


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
           json_path: str | None = None, ranks_path: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per piece of a document in a sequence; with ``with_ids`` also its token ids."""
    if json_path is None:
        json_path, ranks_path = vocabulary()
    tokens = settle(tokenize(docs, doc_id, text, json_path, ranks_path), "packing-tokens")
    placed = tokens.select("nr", "doc_id", "n", "ids").join(starts(tokens).hint("shuffle_hash"), "nr").drop("nr")

    def cut(batches):
        for batch in batches:
            at = batch.column(batch.schema.get_field_index("at")).to_numpy()
            n = batch.column(batch.schema.get_field_index("n")).to_numpy()
            first = at // length
            count = (at + n - 1) // length - first + 1
            row = np.repeat(np.arange(len(n)), count)
            seq = X.ranges(first, count)
            low = np.maximum(seq * length, at[row])
            high = np.minimum((seq + 1) * length, (at + n)[row])
            start = low - at[row]
            size = high - low
            raw = batch.column(batch.schema.get_field_index("ids"))
            crc, own = [], []
            held, ids = -1, None
            for r, a, s in zip(row.tolist(), start.tolist(), size.tolist()):
                if r != held:
                    data = raw[r].as_py()
                    ids = np.frombuffer(data, np.uint16 if len(data) == 2 * n[r] else np.uint32).astype("<u4")
                    held = r
                piece = ids[a : a + s]
                crc.append(zlib.crc32(piece.tobytes()))
                own.append(piece)
            columns = [batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(row)), pa.array(start), pa.array(size),
                       pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(seq), pa.array(low - seq * length)]
            names = [c.split()[0] for c in PIECES.split(", ")]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in own], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return placed.mapInArrow(cut, PIECES + (", ids array<int>" if with_ids else ""))
