"""Connected components of an edge table by repeated contraction.

Every node takes the smallest id among itself and its neighbours as its new name, edges are renamed
and those that became loops vanish; this repeats until no edge is left. Ids that are hashes make the
number of rounds logarithmic. Each round is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); null ends are left out."""
    def tidy(e: DataFrame) -> DataFrame:
        e = e.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return settle(e.distinct(), "edges")

    edges, labels = tidy(edges.select("a", "b")), None
    while True:
        ends = edges.select("a", "b").union(edges.select("b", "a"))
        names = ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
        names = settle(names, "names")
        if labels is None:
            labels = names
        else:
            new = names.select(F.col("node").alias("label"), F.col("label").alias("newer"))
            labels = settle(labels.join(new, "label", "left").select("node", F.coalesce("newer", "label").alias("label")), "labels")
        if edges.isEmpty():
            return labels
        left = names.select(F.col("node").alias("a"), F.col("label").alias("x"))
        right = names.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = tidy(edges.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b")))
