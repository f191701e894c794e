"""Connected components of an edge table by repeated hooking and contraction,
with every step a DataFrame job over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def _roots(parents: DataFrame) -> DataFrame:
    """Pointer doubling: (node, parent) with parent < node, to (node, root).
    The parents form a forest, so the depth halves with every pass."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = staged(parents.join(up, "parent", "left").select(
            "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")), "roots")
        parents = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component is
    the smallest node reachable. Nodes without edges are not returned.

    Each pass hooks every node to its smallest neighbour below it (a partial
    aggregate, so a hub costs one row per task), follows the pointers to their
    roots, and keeps only the edges between different roots. Every node that is
    not a local minimum disappears in a pass, so few passes are needed."""
    edges = edges.select("a", "b").where("a <> b")
    labels = None
    while True:
        both = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent"))
        roots = _roots(staged(both.groupBy("node").agg(F.min("parent").alias("parent")), "hooks"))
        if labels is None:
            low = both.select(F.col("parent").alias("node")).distinct().join(roots, "node", "left_anti")
            labels = roots.unionByName(low.select("node", F.col("node").alias("parent")))
        else:
            step = roots.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
            labels = labels.join(step, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent"))
        labels = staged(labels, "labels")
        edges = staged(_contract(edges, roots), "contracted")
        if edges.isEmpty():
            return labels.select("node", F.col("parent").alias("component"))


def _contract(edges: DataFrame, roots: DataFrame) -> DataFrame:
    for end in ("a", "b"):
        to = roots.select(F.col("node").alias(end), F.col("parent").alias("root"))
        other = "b" if end == "a" else "a"
        edges = edges.join(to, end, "left").select(F.coalesce("root", end).alias(end), other)
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
