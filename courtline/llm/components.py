"""Connected components of an edge table by minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import having, lookup, small

#: A node with more edges than this is a hub: its label is looked up and not joined by a shuffle on it.
HUB_EDGES = 1_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable, for every node of an edge.

    Each round points every node at the least label next to it and then at that label's label. Rounds
    are checkpointed; their number grows with the logarithm of the longest path; nothing is collected.

    No node and no label is a hot key. Least values are taken before the shuffle. Edges at hubs, of which
    there are at most one in HUB_EDGES edges' ends, look their label up; so do all nodes that of the label
    they carry: only labels that moved are in those tables, and ``lookup`` broadcasts or salts them.

    Defined results: an edge of a node with itself and repeated edges change nothing; a NULL end is no node
    and its edge is left out; no edges give no rows; other columns, of any name, are not read.
    """
    pairs = small(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct())
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = small(both.groupBy("a").agg(F.least("a", F.min("b")).alias("c")).withColumnRenamed("a", "node"))
    hubs = small(both.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HUB_EDGES).select("b"))
    at_hubs = None if hubs.isEmpty() else having(both, "b", hubs)
    elsewhere = both if at_hubs is None else having(both, "b", hubs, how="anti")
    while True:
        told = elsewhere.join(labels, elsewhere["b"] == labels["node"]).select("a", "c")
        if at_hubs is not None:
            of_hubs = small(having(labels, "node", hubs).withColumnRenamed("node", "b"))
            told = told.unionByName(lookup(at_hubs, of_hubs, ["b"]).select("a", "c"))
        near = told.groupBy("a").agg(F.min("c").alias("n"))
        offered = small(
            labels.join(near, labels["node"] == near["a"]).select("node", "c", F.least("c", "n").alias("n"))
        )
        # The root of a tree learns the least label that any of its nodes was offered.
        hooks = offered.groupBy("c").agg(F.min("n").alias("h")).filter("h < c")
        hooks = small(hooks.withColumnRenamed("c", "n"))
        moved = lookup(offered, hooks, ["n"]).select(
            "node", F.col("c").alias("old"), F.least("n", F.coalesce("h", "n")).alias("c")
        )
        # Labels that are themselves no roots any more: one row each.
        carried = moved.select(F.col("c").alias("label")).distinct()
        below = moved.filter("c < node").join(carried, F.col("node") == F.col("label"), "semi")
        below = small(below.select(F.col("c").alias("up"), F.col("node").alias("c")))
        jumped = small(
            lookup(moved, below, ["c"]).select("node", "old", F.least("c", F.coalesce("up", "c")).alias("c"))
        )
        labels = jumped.select("node", "c")
        if jumped.filter("c <> old").isEmpty():
            return labels.withColumnRenamed("c", "component")
