"""Connected components of a graph held in a table: distributed union-find.

In each round every node joins its least neighbour if that is less than itself,
the chains so made are halved until each node points at its root, and the edges
are moved to the roots.  At least half of a component's nodes vanish in a round.
A node's many edges are reduced before they are shuffled; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def _jump(parent: DataFrame) -> DataFrame:
    """(node, root) with roots followed to the end."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("over"))
        parent = staged(parent.join(up, "root", "left").select("node", F.coalesce("over", "root").alias("root"), (F.col("over") != F.col("root")).alias("moved")), "cc-jump")
        if parent.where("moved").isEmpty():
            return parent.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): for every node on an edge the least node it can reach.

    Null ends, loops and repeated edges are allowed and change nothing.
    """
    edges = staged(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    found = None
    while not edges.isEmpty():
        least = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("b"))
        # Written first: a join of tables as read is one that can be split where many nodes name one root.
        parent = _jump(staged(least.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "cc-least"))
        if found is None:
            found = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("over"))
            found = staged(found.join(up, "root", "left").select("node", F.coalesce("over", "root").alias("root")), "cc-found")
        side = lambda c: parent.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))  # noqa: E731, B023
        moved = edges.join(side("a"), "a").join(side("b"), "b")
        moved = moved.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
        edges = staged(moved.where("a <> b").distinct(), "cc-edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
