"""Exact top-k inner products by norm buckets.

Components become integers. Candidates are range-sorted by length and cut into buckets of ``BUCKET``
rows with lengths close together. Queries are first compared with the bucket of the longest vectors,
which gives each a lower bound of its k-th score. A query meets a bucket with a local cosine
threshold, its bound over the product of its length and the bucket's greatest length: above 1 the
bucket is skipped; at ``COORD_FROM`` and more candidates are pruned by coordinates (the query's
largest ones bound those of any vector within the angle), below by their length. The products of the
rest are computed exactly and the bound rises from bucket to bucket.

Before anything is copied, queries are put in blocks by the least length that can reach their bound, and a block meets
only the parts of the candidates whose longest vector has that length: parts from the longest on, so the meetings are
one number for each block. A task takes one block of queries and one part of the candidates, both of bounded size; it
returns at most k rows a query that reach the query's bound.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null
id, take no part; vectors of different sizes are compared as if the shorter one ended in zeros;
equal rows are separate candidates, only the query's own row is left out; ties go to the smaller id,
and equal ids and scores take ranks by turns; scores beyond 64 bits are compared exactly and shown
as the nearest long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import settle

K = 5
SCALE = 256
BUCKET = 2048
PART_BUCKETS = 16
QUERY_BLOCK = 4096
COORD_FROM = 0.5
COORDS = 3
SLACK = 1e-9
FOUND = "query_nr long, query_id long, nr long, vec_id long, score decimal(38,0)"


def coded(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(nr, vec_id, norm, v): valid rows, numbered, with integer components as float64 bytes."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))

    def step(batches):
        nr = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = [np.floor(SCALE * np.array(v, np.float64)) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(nr + np.arange(len(out))), batch.column(0), pa.array([float(np.linalg.norm(v)) for v in out], pa.float64()),
                 pa.array([v.tobytes() for v in out], pa.binary())], names=["nr", "vec_id", "norm", "v"])
            nr += len(out)

    return rows.mapInArrow(step, "nr long, vec_id long, norm double, v binary")


def matrix(raw: list[bytes]) -> np.ndarray:
    rows = [np.frombuffer(r, np.float64) for r in raw]
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


class Bucket:
    """Candidates in order of falling length."""

    def __init__(self, nr: np.ndarray, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray):
        order = np.argsort(-norms, kind="stable")
        self.nr, self.ids, self.vectors, self.norms = nr[order], ids[order], vectors[order], norms[order]
        self.top = float(self.norms[0])
        self.unit = self.vectors / np.maximum(self.norms, 1e-300)[:, None]
        self.largest = float(np.abs(self.vectors).max(initial=0))

    def pruned(self, q: np.ndarray, norm: float, bound: float) -> np.ndarray | None:
        """Positions that may reach the bound; None for all."""
        if bound <= 0 or norm == 0 or not math.isfinite(bound):
            return None
        cosine = bound / (norm * self.top) if self.top else math.inf
        if cosine > 1 + SLACK:
            return np.zeros(0, np.int64)
        if cosine < COORD_FROM:
            least = bound / norm * (1 - SLACK)
            return np.arange(int(np.searchsorted(-self.norms, -least, side="right")))
        angle = math.acos(min(1.0, cosine)) + 1e-7
        focus = np.argsort(-np.abs(q))[:COORDS]
        ok = np.ones(len(self.norms), bool)
        for f in focus:
            own = math.acos(max(-1.0, min(1.0, q[f] / norm)))
            low, high = math.cos(min(math.pi, own + angle)), math.cos(max(0.0, own - angle))
            ok &= (self.unit[:, f] >= low - SLACK) & (self.unit[:, f] <= high + SLACK)
        return np.flatnonzero(ok)


def products(vectors: np.ndarray, q: np.ndarray, largest: float):
    """Exact integer inner products."""
    width = min(vectors.shape[1], len(q))
    top = float(np.abs(q).max(initial=0))
    if largest * top * max(1, width) < 2**53:
        return (vectors[:, :width] @ q[:width]).astype(np.int64)
    whole = [int(x) for x in q[:width]]
    return np.array([sum(int(a) * b for a, b in zip(row[:width], whole)) for row in vectors], object)


def best(buckets: list[Bucket], query_nr: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
    """For each query its k best (score, id, nr) among the buckets that reach its bound."""
    out = []
    for nr, q, bound in zip(query_nr.tolist(), queries, bounds.tolist()):
        norm, top = float(np.linalg.norm(q)), []
        exact = True
        for bucket in buckets:
            at = bucket.pruned(q, norm, bound) if exact else None
            chosen = slice(None) if at is None else at
            ids, own = bucket.ids[chosen], bucket.nr[chosen]
            if not len(ids):
                continue
            score = products(bucket.vectors[chosen], q, bucket.largest)
            exact &= score.dtype != object
            if len(top) == k and score.dtype != object:
                good = score >= top[-1][0]
                score, ids, own = score[good], ids[good], own[good]
            if len(score) > 4 * k and score.dtype != object:
                # all that tie with the k-th stay; one more, as the query's own row may be among them
                good = score >= np.partition(score, -k - 1)[-k - 1]
                score, ids, own = score[good], ids[good], own[good]
            top += [(s, i, o) for s, i, o in zip(score.tolist(), ids.tolist(), own.tolist()) if o != nr]
            top = sorted(top, key=lambda x: (-x[0], x[1], x[2]))[:k]
            if len(top) == k:
                bound = max(bound, float(top[-1][0]))
        out.append(top)
    return out


def _grouped(table: pa.Table) -> Bucket:
    return Bucket(table.column("nr").to_numpy(), table.column("vec_id").to_numpy(), matrix(table.column("v").to_pylist()), table.column("norm").to_numpy())


def meetings(needs: list[float], tops: list[float]) -> list[int]:
    """For each block of queries, by the least length it needs, how many parts, from the longest on, it meets."""
    order = np.array(tops, float)  # falling
    return [int(np.searchsorted(-order, -need, side="right")) for need in needs]


def search(vectors: DataFrame, is_query, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row for which ``is_query`` (a column) holds."""
    spark = vectors.sparkSession
    rows = settle(coded(vectors, vec_id, embedding), "topk-vectors")
    chosen = rows.where(is_query)
    n, n_queries = rows.count(), chosen.count()
    parts = max(1, math.ceil(n / (BUCKET * PART_BUCKETS)))
    blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    ordered = rows.repartitionByRange(parts, F.col("norm").desc(), "vec_id", "nr").sortWithinPartitions(F.col("norm").desc(), "vec_id", "nr")
    cut = settle(ordered.withColumn("part", F.spark_partition_id().cast("long")), "topk-buckets")
    blocked = chosen.withColumn("block", F.pmod(F.xxhash64("nr"), F.lit(blocks)))
    longest = cut.orderBy(F.col("norm").desc(), "vec_id", "nr").limit(BUCKET)
    seeds = settle(longest, "topk-seed")

    def first(key, queries, seed):
        if not queries.num_rows or not seed.num_rows:
            return pa.table({"nr": pa.array([], pa.int64()), "bound": pa.array([], pa.float64())})
        nr = queries.column("nr").to_numpy()
        none = np.full(len(nr), -math.inf)
        tops = best([_grouped(seed)], nr, matrix(queries.column("v").to_pylist()), none, k)
        return pa.table({"nr": pa.array(nr), "bound": pa.array([float(t[-1][0]) if len(t) == k else -math.inf for t in tops])})

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    bounds = blocked.groupBy("block").cogroup(seeds.select("*", every).groupBy("block")).applyInArrow(first, "nr long, bound double")
    need = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm") * (1 - 1e-6)).otherwise(0.0)
    by_need = blocked.drop("block").join(bounds, "nr").withColumn("need", need).repartitionByRange(blocks, "need", "nr")
    ready = settle(by_need.withColumn("block", F.spark_partition_id().cast("long")), "topk-queries")
    # One number for each 4,096 queries and each 32,768 vectors.
    ranked_parts = cut.groupBy("part").agg(F.max("norm").alias("top")).orderBy(F.desc("top"), "part").collect()
    tops, numbered = [r.top for r in ranked_parts], [r.part for r in ranked_parts]
    least = ready.groupBy("block").agg(F.min("need")).orderBy("block").collect()
    met_parts = meetings([r[1] for r in least], tops)
    pairs = [(int(r[0]), [int(p) for p in numbered[:m]]) for r, m in zip(least, met_parts)]
    pairs = spark.createDataFrame(pairs, "block long, parts array<long>").select("block", F.explode("parts").alias("part"))
    pairs = settle(pairs, "topk-pairs")

    def meet(key, queries, candidates):
        names = [c.split()[0] for c in FOUND.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.decimal128(38, 0)]
        if not queries.num_rows or not candidates.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        candidates = candidates.sort_by([("norm", "descending"), ("vec_id", "ascending"), ("nr", "ascending")])
        buckets = [_grouped(candidates.slice(i, BUCKET)) for i in range(0, candidates.num_rows, BUCKET)]
        nr, ids = queries.column("nr").to_numpy(), queries.column("vec_id").to_pylist()
        tops = best(buckets, nr, matrix(queries.column("v").to_pylist()), queries.column("bound").to_numpy(), k)
        cap = 10**38 - 1
        out = [(int(o), q, int(c), int(i), max(-cap, min(cap, int(s)))) for o, q, top in zip(nr, ids, tops) for s, i, c in top]
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.table([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=names)

    spread = ready.select("nr", "vec_id", "v", "bound", "block").join(pairs, "block")
    copied = cut.select("nr", "vec_id", "norm", "v", "part").join(pairs, "part")
    met = spread.groupBy("block", "part").cogroup(copied.groupBy("block", "part")).applyInArrow(meet, FOUND)
    order = Window.partitionBy("query_nr", "query_id").orderBy(F.col("score").desc(), "vec_id", "nr")
    low, high = F.lit(-(2**63)), F.lit(2**63 - 1)
    clipped = F.least(F.greatest(F.col("score"), low.cast("decimal(38,0)")), high.cast("decimal(38,0)")).cast("long")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", clipped.alias("score"))
