"""Connected components of a graph that never leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs of longs -> (node, root): the smallest node that each node is connected to.

    Large-star and small-star steps in turn: each hangs a node's neighbours on the smallest node
    around, which keeps the number of edges and reaches stars in a logarithmic number of rounds.
    A round is joins and aggregations over edges; a hub is one key of a join, which adaptive
    execution splits. Every step is written to the shared scratch folder. Nodes without an edge to
    another node are not in the result; loops and repeated edges do no harm.
    """
    now = stored(
        edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), "edges"
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.selectExpr("a node", "b root")
        before = state
        now = stored(_small_star(stored(_large_star(now), "edges")), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to the smallest of it and its neighbours."""
    both = edges.unionByName(edges.selectExpr("b a", "a b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) m")
    return both.where("b > a").join(least, "a").selectExpr("b a", "m b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of these; all edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").selectExpr("b a", "m b")
    return moved.unionByName(least.selectExpr("a", "m b")).distinct()
