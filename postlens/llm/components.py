"""Connected components of a graph given as rows, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.shared import materialize


def _minimum(pairs: DataFrame) -> DataFrame:
    """(u, m): each node with the least of its neighbours and itself; summed before the shuffle, so a hub is a row per task."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minimum(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _minimum(down)
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (u, v), the component being its least node.

    Each round writes its edges to the shared folder. It ends when a round changes nothing: all edges then lead from a node to
    its component's least node. The rounds grow with the logarithm of the longest path.
    """
    sum_of = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    now = materialize(edges.select("u", "v").filter("u <> v").distinct(), "component-edges")
    before, state = None, sum_of(now)
    while state != before and state[0]:
        now = materialize(_small_star(_large_star(now).distinct()).filter("u <> v").distinct(), "component-edges")
        before, state = state, sum_of(now)
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
