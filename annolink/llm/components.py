"""Connected components by distributed union-find.

Every round hooks each node to its smallest neighbour, shortens the parent
chains by pointer jumping and contracts the edges to the parents; edges inside a
tree vanish.  Parents are smaller than their children, so the last node left of
a component is its smallest.  Minima are partial aggregates, so a node with very
many edges costs no task more than its share.  Each round's tables are written
to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from annolink.llm.common import stored


def _parents(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return both.groupBy("node").agg(F.min("other").alias("other")).select(
        "node", F.least("node", "other").alias("parent"))


def _jump(parents: DataFrame) -> DataFrame:
    up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
    return parents.join(up, "parent").select("node", F.col("grand").alias("parent"))


def components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``node, component``: the smallest node each
    node is linked with.  Loops, repeated edges, either direction and null ends
    are fine (an edge with a null end is no edge); no edges, no rows."""
    edges = stored(edges.where("a is not null and b is not null and a <> b")
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        parents = stored(_jump(stored(_parents(edges), "parents")), "jumped")
        step = parents.withColumnRenamed("node", "component")
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            labels = labels.join(step, "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component"))
        labels = stored(labels, "labels")
        a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(a, "a").join(b, "b").where("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = stored(moved.distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
