"""Connected components by contraction, as joins and aggregations on tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b), component being the smallest node reachable.

    Each round every node points to its smallest neighbour or itself, pointers are followed one step
    further, and edges are redrawn between what their ends point to; edges inside one node go. Rounds are
    few (about the logarithm of the longest path) and each shrinks the edges. Nodes with very many edges
    are met by partial aggregation and by joins that Spark can split.
    """
    left = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    label = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")).select(F.col("a").alias("v"), "p"), "cc-parents")
        nxt = parent.select(F.col("v").alias("p"), F.col("p").alias("q"))
        parent = written(parent.join(nxt, "p").select("v", F.col("q").alias("p")), "cc-jumped")
        if label is None:
            label = parent.select(F.col("v").alias("node"), F.col("p").alias("component"))
        else:
            moved = parent.select(F.col("v").alias("component"), F.col("p").alias("to"))
            label = written(label.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "cc-labels")
        pa, pb = parent.toDF("a", "pa"), parent.toDF("b", "pb")
        drawn = left.join(pa, "a").join(pb, "b").where("pa <> pb")
        left = written(drawn.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-edges")
    return label if label is not None else left.select(F.col("a").alias("node"), F.col("b").alias("component"))
