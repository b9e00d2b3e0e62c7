"""Connected components of an edge table, by label passing with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arspark.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node with an edge (columns a, b); root is the smallest node it reaches.

    Each pass takes the smallest root among a node's neighbours (partial
    aggregation, so a node with very many edges is no hot group), hands it on to
    the node's former root, and then jumps to the root's root. The number of
    passes grows with the logarithm of the longest chain.
    """
    both = scratch.save(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    while True:
        # the smallest root around a node goes to the node and to its root
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
        told = labels.join(heard, "node").select("node", "root", F.least("root", "r").alias("r"))
        hooked = told.groupBy(F.col("root").alias("node")).agg(F.min("r").alias("hook"))
        best = told.join(hooked, "node", "left").select("node", "root", F.least("r", F.coalesce("hook", "r")).alias("r"))
        jump = best.select(F.col("node").alias("r"), F.col("r").alias("far"))
        moved = best.join(jump, "r", "left").select("node", F.col("root").alias("old"), F.least("r", F.coalesce("far", "r")).alias("root"))
        after = scratch.save(moved)
        scratch.drop(labels)
        labels = after
        if after.filter("old != root").isEmpty():
            scratch.drop(both)
            return labels.select("node", "root")
