"""Connected components of a distributed edge list by alternating large and small stars.

Every round replaces a node's edges by edges to its smallest neighbour. Neighbourhoods are never gathered: a round is
a minimum by node (combined before the shuffle) joined back to the edges, so a node with a third of all edges costs a
skewed join, which Spark splits. Rounds grow with the logarithm of the longest path. Each round's edges are written to
the shared folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from statement_spark.session import staged


def _smallest(edges: DataFrame) -> DataFrame:
    """Written first, so that the join reads both sides from shuffles of its own and Spark can split a hot node."""
    return staged(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = both.where("b > a").join(_smallest(both), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(_smallest(down), "a")
    moved = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(joined.select("a", F.col("least").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: bigint); root is the smallest node of its component.

    Null ends and loops are left out; repeated edges do no harm; no edges give no rows.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if (seen["n"], seen["s"]) == mark:
            break
        mark = (seen["n"], seen["s"])
        now = staged(_small_star(_large_star(now)), "edges")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
