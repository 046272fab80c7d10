"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document is the set of its distinct 3-word shingles (64-bit hashes); documents with equal sets are
one class from the start. Two sets are linked when 100 * |A & B| >= PERCENT * |A | B|.

1. Every set gives a prefix to the hash shards of tokens: its smallest hashes, long enough that linked
   sets have at least ``slack`` of them in common. Shards count in how many sets a token occurs there.
2. Tokens of one set only cannot link and are dropped. Of the rest a set keeps the rarest, so many that
   linked sets still share one: ordinary passages that many documents share fall out here.
3. Sets with identical remaining prefix and size collapse into one group. Groups that share a token
   and whose sizes fit become candidates, through a hub for each token and size band, so a token
   gives as many pairs as it has groups, never all pairs.
4. Connected candidates form clusters; each class brings its whole set once. A cluster is searched
   breadth first from set to set against all sets not reached yet, skipping those that sizes or the
   triangle inequality of Jaccard distances rule out. What is reached is linked; every pair of
   different components has been ruled out or compared, so components are exact. Clusters above
   ``CLUSTER_SHINGLES`` are cut into parts and every two parts are searched together.

Defined results: without words the set is empty and linked with nothing (component: its own id; rows
without words are alone even when equal); fewer words than a shingle form one; equal texts are linked;
documents that share a doc_id are separate rows; null ids count as absent when the smallest is taken;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm import blocks as B, textops as X
from tidemark.llm.components import components
from tidemark.session import settle

SIZE = 3
PERCENT = 90
SHARD_TOKENS = 1 << 20
CLUSTER_SHINGLES = 1 << 20
PIVOTS = 8


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of ``n`` that go to the index: linked sets share at least :func:`slack` of them."""
    return n - (percent * n + 99) // 100 + slack(n)


def slack(n: int) -> int:
    return 1 + n // 10


def shingle_sets(column: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    data, bounds = X.text_bytes(column)
    data = X.LOWER[data]
    starts, ends, word_bounds = X.word_spans(data, bounds, X.NOT_SPACE)
    words = X.word_hashes(data, starts, ends)
    windows = X.window_hashes(words, size)
    out = []
    for a, b in zip(word_bounds[:-1].tolist(), word_bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        else:
            out.append(X.mix(X.window_hashes(words[a:b], b - a), 5) if b > a else np.zeros(0, X.U64))
    return out


def class_id(tokens: np.ndarray) -> bytes:
    """128 bits that name a set."""
    n = X.U64(len(tokens))
    parts = [X.mix(np.array([X.mix(tokens, salt).sum(dtype=X.U64) + n]), salt)[0] for salt in (21, 22)]
    return np.array(parts, ">u8").tobytes()


def profiles(docs: DataFrame, size: int) -> DataFrame:
    def step(batches):
        for batch in batches:
            for part in X.slices(batch, "text"):
                sets = shingle_sets(part.column(1), size)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([class_id(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64())], names=["doc_id", "cid", "n"])

    return docs.mapInArrow(step, "doc_id long, cid binary, n long")


def rare_tokens(docs: DataFrame, size: int, percent: int, shards: int) -> DataFrame:
    """(cid, n, tokens): the rarest of the prefix tokens that at least two sets have, as many as can be needed."""

    def step(batches):
        for batch in batches:
            for part in X.slices(batch, "text"):
                sets = {class_id(s): s for s in shingle_sets(part.column(0), size) if len(s)}
                if not sets:
                    continue
                cids = np.frombuffer(b"".join(sets), "V16")
                sizes = np.array([len(s) for s in sets.values()], np.uint32)
                heads = [s[: prefix_length(len(s), percent)] for s in sets.values()]
                token = np.concatenate(heads)
                owner = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
                order, edges = B.shard_runs((X.mix(token, 7) % X.U64(shards)).astype(np.int64), shards)
                rows = []
                for s, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    if b > a:
                        mine = owner[order[a:b]]
                        at = X.run_starts(mine)
                        rows.append((s, cids[mine[at]].tobytes(), sizes[mine[at]].tobytes(),
                                     B.squeeze(np.diff(np.append(at, len(mine))).astype(np.uint32)), token[order[a:b]].tobytes()))
                kinds = [pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["shard", "cids", "sizes", "runs", "tokens"]
                )

    def count(_, table):
        cids = np.frombuffer(b"".join(table.column("cids").to_pylist()), "V16")
        sizes = np.frombuffer(b"".join(table.column("sizes").to_pylist()), np.uint32)
        runs = np.concatenate([B.unsqueeze(x, np.uint32) for x in table.column("runs").to_pylist()])
        token = np.frombuffer(b"".join(table.column("tokens").to_pylist()), X.U64)
        distinct, code = np.unique(cids.view(">u8").reshape(-1, 2), axis=0, return_inverse=True)
        size = np.zeros(len(distinct), np.int64)
        size[code] = sizes
        owner = np.repeat(code.reshape(-1), runs)
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        new = np.ones(len(token), bool)  # copies in other blocks bring the same pairs
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner = token[new], owner[new]
        at = X.run_starts(token)
        sets = np.repeat(np.diff(np.append(at, len(token))), np.diff(np.append(at, len(token))))
        many = sets > 1
        return packed(distinct, size, token[many], owner[many], sets[many])

    def packed(distinct, size, token, owner, sets):
        """One row for each bin of classes that has shared tokens here."""
        place = (X.mix(distinct[:, 0].astype(X.U64), 9) % X.U64(shards)).astype(np.int64)[owner]
        order = np.lexsort((owner, place))
        token, owner, sets, place = token[order], owner[order], sets[order], place[order]
        edges, rows = np.append(X.run_starts(place), len(place)), []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            mine = owner[a:b]
            at = X.run_starts(mine)
            runs = np.diff(np.append(at, len(mine))).astype(np.uint32)
            rows.append((int(place[a]), distinct[mine[at]].astype(">u8").tobytes(), size[mine[at]].tobytes(), B.squeeze(runs),
                         B.squeeze(sets[a:b].astype(np.int64)), token[a:b].tobytes()))
        cols = list(zip(*rows)) if rows else [[]] * 6
        names = ["bin", "cids", "sizes", "runs", "sets", "tokens"]
        return pa.table([pa.array(list(c), k) for c, k in zip(cols, [pa.int64(), *[pa.binary()] * 5])], names=names)

    def select(_, table):
        cids = np.frombuffer(b"".join(table.column("cids").to_pylist()), ">u8").reshape(-1, 2)
        sizes = np.frombuffer(b"".join(table.column("sizes").to_pylist()), np.int64)
        runs = np.concatenate([B.unsqueeze(x, np.uint32) for x in table.column("runs").to_pylist()])
        sets = np.concatenate([B.unsqueeze(x, np.int64) for x in table.column("sets").to_pylist()])
        token = np.frombuffer(b"".join(table.column("tokens").to_pylist()), X.U64)
        distinct, code = np.unique(cids, axis=0, return_inverse=True)
        code = code.reshape(-1)
        size = np.zeros(len(distinct), np.int64)
        size[code] = sizes
        owner = np.repeat(code, runs)
        order = np.lexsort((token, sets, owner))
        token, owner = token[order], owner[order]
        at = X.run_starts(owner)  # every class has a token
        held = np.diff(np.append(at, len(owner)))
        # linked sets share this many of the tokens sent; all shared ones are here, and one of them is among the rest
        sure = 1 + ((percent * size + 99) // 100) // 10
        left = np.maximum(0, held - sure + 1)
        chosen = np.arange(len(owner)) - at[owner] < left[owner]
        have = np.flatnonzero(left)
        offsets = pa.array(np.concatenate([[0], np.cumsum(left[have])]).astype(np.int32))
        raw = distinct.astype(">u8").tobytes()
        return pa.table({
            "cid": pa.array([raw[16 * i : 16 * i + 16] for i in have.tolist()], pa.binary()), "n": pa.array(size[have]),
            "tokens": pa.ListArray.from_arrays(offsets, pa.array(token[chosen].view(np.int64))),
        })

    sent = docs.select("text").mapInArrow(step, "shard long, cids binary, sizes binary, runs binary, tokens binary")
    shared = sent.groupBy("shard").applyInArrow(count, "bin long, cids binary, sizes binary, runs binary, sets binary, tokens binary")
    return shared.groupBy("bin").applyInArrow(select, "cid binary, n long, tokens array<long>")


def candidates(rare: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between classes that may be linked; clusters of these edges hold every link."""
    kept = settle(rare, "jaccard-prefixes")
    groups = kept.groupBy("n", "tokens").agg(F.min("cid").alias("head"))
    grouped = kept.join(groups, ["n", "tokens"])
    inside = grouped.where("cid != head").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    # bands of sizes: sets that can be linked lie in one band or in neighbouring ones
    band = F.floor(F.log("n") / math.log(100 / percent)).alias("band")
    index = groups.select("head", band, F.explode("tokens").alias("token"))
    index = settle(index, "jaccard-index")
    hubs = settle(index.groupBy("token", "band").agg(F.min("head").alias("hub")), "jaccard-hubs")
    spokes = index.join(hubs, ["token", "band"]).where("head != hub").select(F.col("head").alias("a"), F.col("hub").alias("b"))
    # two bands up as well, so that rounding of the logarithm cannot part neighbours
    steps = hubs.select("token", "hub", F.explode(F.array(F.col("band") + 1, F.col("band") + 2)).alias("band"))
    between = steps.join(hubs.withColumnRenamed("hub", "b"), ["token", "band"]).select(F.col("hub").alias("a"), "b")
    return inside.unionByName(spokes).unionByName(between).where("a != b").distinct()


def search(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that span the components of some sets under the Jaccard threshold."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    begin = np.cumsum(size) - size
    free = np.ones(len(sets), bool)
    pivots: list[np.ndarray] = []
    reach = 1 - percent / 100 + 1e-9
    links = []
    for root in np.argsort(-size, kind="stable").tolist():
        if not free[root]:
            continue
        free[root] = False
        queue = [root]
        while queue:
            x = queue.pop()
            fits = free & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
            for d in pivots:
                fits &= ~(np.abs(d - d[x]) > reach)  # unknown distances rule nothing out
            c = np.flatnonzero(fits)
            if not len(c):
                continue
            tokens = flat[X.ranges(begin[c], size[c])]
            at = np.searchsorted(sets[x], tokens)
            same = sets[x][np.minimum(at, size[x] - 1)] == tokens
            common = np.add.reduceat(same, np.cumsum(size[c]) - size[c], dtype=np.int64)
            union = size[c] + size[x] - common
            if len(pivots) < PIVOTS and len(c) > 32:
                d = np.full(len(sets), np.nan)
                d[c], d[x] = 1 - common / union, 0
                pivots.append(d)
            linked = c[100 * common >= percent * union]
            links += [(x, y) for y in linked.tolist()]
            free[linked] = False
            queue += linked.tolist()
    return links


def links(docs: DataFrame, known: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) that span the true components inside the clusters (node, label)."""
    member = known.groupBy("cid", "n").agg(F.min("doc_id").alias("doc_id"))
    member = member.join(clusters.select(F.col("node").alias("cid"), F.col("label").alias("cluster")), "cid")
    member = settle(member, "jaccard-members")
    volume = member.groupBy("cluster").agg(F.sum("n").alias("volume"))
    parts = F.ceil(F.col("volume") / CLUSTER_SHINGLES).cast("int")
    total = member.agg(F.sum("n")).first()[0] or 0
    bins = max(1, math.ceil(total / CLUSTER_SHINGLES))
    placed = member.join(volume, "cluster").withColumn("parts", parts)
    mine = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    # every two parts of a large cluster meet in a task of their own; small clusters share tasks
    others = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.concat_ws(":", F.hex("cluster"), F.least(mine, j), F.greatest(mine, j)),
    )
    pairs = F.when(F.col("parts") == 1, F.array(F.pmod(F.xxhash64("cluster"), F.lit(bins)).cast("string"))).otherwise(
        F.when(F.col("parts") == 2, F.array(F.concat_ws(":", F.hex("cluster"), F.lit("0:1")))).otherwise(others)
    )
    wanted = placed.select(F.col("doc_id").alias("w"), "cid", "cluster", pairs.alias("tasks"))
    found = docs.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("w"))).select("text", "cid", "cluster", "tasks")

    def bring(batches):
        for batch in batches:
            for part in X.slices(batch, "text"):
                cids = part.column(1).to_pylist()
                sets = shingle_sets(part.column(0), size)
                good = [i for i, s in enumerate(sets) if len(s) and class_id(s) == cids[i]]
                rows = part.take(pa.array(good, pa.int64()))
                raw = pa.array([sets[i].tobytes() for i in good], pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], raw], names=["cid", "cluster", "tasks", "shingles"])

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("cid", "ascending")])
        cids, clusters_ = table.column("cid").to_pylist(), table.column("cluster").to_pylist()
        raw = table.column("shingles").to_pylist()
        out, at = [], 0
        while at < len(cids):
            stop = at
            mine: dict[bytes, np.ndarray] = {}
            while stop < len(cids) and clusters_[stop] == clusters_[at]:
                mine[cids[stop]] = np.frombuffer(raw[stop], X.U64)
                stop += 1
            names = list(mine)
            out += [(names[x], names[y]) for x, y in search(list(mine.values()), percent)]
            at = stop
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    sets = found.mapInArrow(bring, "cid binary, cluster binary, tasks array<string>, shingles binary")
    sets = sets.select("cid", "cluster", "shingles", F.explode("tasks").alias("task"))
    return sets.groupBy("task").applyInArrow(verify, "a binary, b binary")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, the class of equal sets and component_id, the smallest doc_id reachable by links."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = settle(profiles(docs, size), "jaccard-profiles")
    total = known.agg(F.sum("n")).first()[0] or 0
    shards = B.counts(total // 5, SHARD_TOKENS)
    clusters = components(candidates(rare_tokens(docs, size, percent, shards), percent))
    same = components(settle(links(docs, known, clusters, size, percent), "jaccard-links"))
    lowest = known.where("cid IS NOT NULL").groupBy("cid").agg(F.min("doc_id").alias("doc_id"))
    named = lowest.join(same.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    named = settle(named, "jaccard-classes")
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    per_class = named.join(smallest, "label").select("cid", "component_id")
    joined = known.join(per_class, "cid", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "cid"
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with the smallest doc_id (null ids last, then by the name of the set, then any of
    equal rows); rows without words, null and empty texts among them, all stay. All columns are kept, whatever their names."""
    found = settle(join(docs, doc_id, text, size, percent).where("cid IS NOT NULL"), "jaccard-found")
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "cid")
    # components are named by their smallest id; classes with null ids only, by their set
    named = found.select("doc_id", "cid", "component_id", F.when(F.col("component_id").isNull(), F.col("cid")).alias("own"))
    first = named.groupBy("component_id", "own").agg(F.min(key).alias("first"))
    judged = named.join(first, named["component_id"].eqNullSafe(first["component_id"]) & named["own"].eqNullSafe(first["own"]))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("cid") == F.col("first.cid"))
    gone = judged.where(~same).select(F.col("doc_id").alias("__doc"), F.col("cid").alias("__set")).distinct()
    repeats = judged.where(same).groupBy("doc_id", "cid").count().where("count > 1")
    repeats = settle(repeats.select(F.col("doc_id").alias("__doc"), F.col("cid").alias("__set")), "jaccard-repeats")
    mark, doc, named_set = (X.fresh(n, docs.columns) for n in ("__cid", "__doc", "__set"))
    gone, repeats = (d.toDF(doc, named_set) for d in (gone, repeats))

    def name_sets(batches):
        for batch in batches:
            for part in X.slices(batch, text):
                cids = [class_id(s) if len(s) else None for s in shingle_sets(part.column(part.schema.get_field_index(text)), size)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cids, pa.binary())], names=[*part.schema.names, mark])

    marked = docs.mapInArrow(name_sets, T.StructType([*docs.schema.fields, T.StructField(mark, T.BinaryType())]))
    on = F.col(doc_id).cast("long").eqNullSafe(F.col(doc)) & (F.col(mark) == F.col(named_set))
    kept = marked.join(gone.hint("shuffle_hash"), on, "left_anti")
    if not repeats.isEmpty():
        alone = kept.join(repeats.hint("shuffle_hash"), on, "left_anti")
        kept = alone.unionByName(kept.join(repeats.hint("shuffle_hash"), on, "left_semi").dropDuplicates([doc_id, mark]))
    return kept.select(*docs.columns)
