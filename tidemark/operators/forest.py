"""Isolation forest (Liu, Ting & Zhou 2008), one forest per group, as a Spark job.

Sampling, growing and scoring are shuffles with bounded groups:

* one pass takes the ``POOL_ROWS`` rows with the smallest hash of each group; only about that many rows a group are
  shuffled, however many trees there are;
* each tree draws its own sample of at most 256 rows from the pool, which is the whole group up to 4,096 rows and
  a uniform sample of a larger one; blocks of trees grow in parallel;
* rows are scored in hash chunks of about 4,096, each paired with its group's trees, so a group of any size is
  spread over as many tasks as it needs.

A forest is a table (group, tree, sampled, nodes as arrays) that can be stored and scored again: see :func:`fit`,
:func:`from_nodes` and the ``forest`` argument of :func:`score`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

# Fixed values of the detector.
TREES = 100
SAMPLE_ROWS = 256
SEED = 42

CHUNK_ROWS = 4096
POOL_ROWS = 4096
# A row of a large group is sent with probability POOL_FACTOR * POOL_ROWS / size. Too few for the pool would be a
# deviation of 30 standard errors.
POOL_FACTOR = 1.5
TREE_BLOCK = 25

FOREST = (
    "tree INT, sampled INT, rows BIGINT, "
    "feature ARRAY<INT>, threshold ARRAY<DOUBLE>, low ARRAY<INT>, high ARRAY<INT>, path ARRAY<DOUBLE>"
)


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Average unsuccessful-search depth c(n) of a binary search tree with n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    general = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, general, np.where(n == 2, 1.0, 0.0))


def grow_tree(points: np.ndarray, rng: np.random.Generator) -> dict[str, list]:
    """Random splits until a point is alone, all points agree, or the depth limit is reached.

    Leaves point to themselves, so walking a fixed number of steps is safe.
    """
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    tree: dict[str, list] = {"feature": [], "threshold": [], "low": [], "high": [], "path": []}

    def add(rows: np.ndarray, depth: int) -> int:
        node = len(tree["feature"])
        for name, value in (("feature", 0), ("threshold", 0.0), ("low", node), ("high", node)):
            tree[name].append(value)
        tree["path"].append(depth + float(mean_path(len(rows))))
        if depth >= limit or len(rows) <= 1:
            return node
        lows, highs = rows.min(axis=0), rows.max(axis=0)
        splittable = np.flatnonzero(highs > lows)
        if not len(splittable):
            return node
        feature = int(splittable[rng.integers(len(splittable))])
        cut = float(rng.uniform(lows[feature], highs[feature]))
        below = rows[:, feature] <= cut
        tree["feature"][node], tree["threshold"][node] = feature, cut
        tree["low"][node] = add(rows[below], depth + 1)
        tree["high"][node] = add(rows[~below], depth + 1)
        return node

    add(points, 0)
    return tree


def path_lengths(points: np.ndarray, tree: dict[str, np.ndarray], steps: int) -> np.ndarray:
    at = np.zeros(len(points), dtype=int)
    rows = np.arange(len(points))
    for _ in range(steps):
        below = points[rows, tree["feature"][at]] <= tree["threshold"][at]
        at = np.where(below, tree["low"][at], tree["high"][at])
    return tree["path"][at]


def pools(
    df: DataFrame, group: str, row_key: Sequence[str], features: Sequence[str], size: str, seed: int
) -> DataFrame:
    """One row per group: its size and the points of its pool as an array, in hash order."""
    # The top 53 bits as a uniform number in [0, 1).
    draw = F.shiftrightunsigned(F.xxhash64(group, *row_key, F.lit(seed)), 11) / F.lit(float(2**53))
    point = F.array(*[F.col(f).cast("double") for f in features])
    sent = df.select(group, size, *row_key, draw.alias("_draw"), point.alias("_point"))
    sent = sent.where(F.col("_draw") * F.col(size) < POOL_FACTOR * POOL_ROWS)
    entries = F.array_sort(F.collect_list(F.struct("_draw", *row_key, "_point")))
    pooled = sent.groupBy(group).agg(F.max(size).alias(size), F.slice(entries, 1, POOL_ROWS).alias("_pool"))
    return pooled.select(group, size, F.transform("_pool", lambda e: e["_point"]).alias("pool"))


def fit(
    df: DataFrame, group: str, row_key: Sequence[str], features: Sequence[str], size: str, trees: int, seed: int
) -> DataFrame:
    """One row per (group, tree) with the tree as arrays."""
    blocks = -(-trees // TREE_BLOCK)

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                name, rows, points, block = row
                points = np.stack(points).astype(float)
                out = []
                for tree in range(block * TREE_BLOCK, min(trees, (block + 1) * TREE_BLOCK)):
                    rng = np.random.default_rng([seed, tree, zlib.crc32(str(name).encode())])
                    drawn = rng.choice(len(points), min(SAMPLE_ROWS, len(points)), replace=False)
                    out.append({group: name, "tree": tree, "sampled": len(drawn), "rows": rows, **grow_tree(points[drawn], rng)})
                yield pd.DataFrame(out)

    # An explicit count: pools are small in bytes but dear to grow trees from, so they
    # must not be merged into few partitions.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocked = pools(df, group, row_key, features, size, seed).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    return blocked.repartition(spread, group, "_block").mapInPandas(grow, f"{group} STRING, {FOREST}")


def from_nodes(nodes: DataFrame, group: str) -> DataFrame:
    """The forest of a table of nodes (group, tree, sampled, node, feature, threshold, low, high, path), node 0 the
    root and leaves pointing to themselves."""
    fields = ("feature", "threshold", "low", "high", "path")
    ordered = F.array_sort(F.collect_list(F.struct("node", *fields)))
    trees = nodes.groupBy(group, "tree", "sampled").agg(ordered.alias("_nodes"))
    arrays = [F.col("_nodes")[f].alias(f) for f in fields]
    return trees.select(group, F.col("tree").cast("int"), F.col("sampled").cast("int"), *arrays)


def score(
    df: DataFrame,
    group: str,
    row_key: Sequence[str],
    features: Sequence[str],
    size: str,
    contamination: float,
    min_size: int = 1,
    trees: int = TREES,
    seed: int = SEED,
    forest: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus ``decision`` (negative = anomalous) and ``is_outlier``.

    ``size`` holds the row count of the group. Groups below ``min_size`` are passed through
    with a NULL decision. The decision is the sample score minus its exact ``contamination``
    quantile within the group. ``forest`` is a stored forest to score with instead of growing one.
    """
    feature_names = list(features)
    steps = int(np.ceil(np.log2(SAMPLE_ROWS)))

    def walk(rows: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        out = rows.drop(columns=["_chunk"])
        out["_score"] = np.nan
        if len(rows) and len(forest):
            points = rows[feature_names].to_numpy(dtype=float)
            forest = forest.sort_values("tree")
            total = np.zeros(len(points))
            for tree in forest.itertuples(index=False):
                arrays = {f: np.asarray(getattr(tree, f)) for f in ("feature", "threshold", "low", "high", "path")}
                total += path_lengths(points, arrays, steps)
            norm = len(forest) * float(mean_path(forest["sampled"].iloc[0]))
            out["_score"] = -np.power(2.0, -total / norm) if norm else -0.5
        return out

    chunks = F.greatest(F.ceil(F.col(size) / CHUNK_ROWS), F.lit(1)).cast("long")
    rows = df.withColumn("_chunk", F.pmod(F.xxhash64(*row_key), chunks))
    large = F.col(size) >= min_size
    if forest is None:
        forest = fit(df.where(large), group, row_key, features, size, trees, seed).withColumnRenamed("rows", size)
    else:
        sizes = df.where(large).groupBy(group).agg(F.max(size).alias(size))
        forest = forest.drop(size).join(sizes, group)
    # fresh attributes: a stored forest may come from the frame that is scored
    forest = forest.select(
        F.col(group).alias(group), "tree", "sampled", "feature", "threshold", "low", "high", "path",
        F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("_chunk"),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", _score DOUBLE"
    scored = rows.groupBy(group, "_chunk").cogroup(forest.groupBy(group, "_chunk")).applyInPandas(walk, schema)
    # One value per row of the group; see the callers for what bounds a group.
    cut = F.percentile(F.col("_score"), F.lit(contamination)).over(Window.partitionBy(group))
    return scored.withColumn("decision", F.col("_score") - cut).select(
        *df.columns, "decision", F.coalesce(F.col("decision") < 0, F.lit(False)).alias("is_outlier")
    )
