"""Connected components of an edge table, by alternating large and small stars.

Every round is an aggregate (with map-side combine) and a join; a hub's edges are never gathered in
one task. Rounds grow with the logarithm of the longest chain. Lineage is cut in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.shared import cut


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Link each node's neighbours to the smallest node around it.

    Large star (both_ways): neighbours larger than the node. Small star: edges point from the
    larger to the smaller end; all smaller neighbours and the node itself.
    """
    if both_ways:
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = around.where("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest reachable node.

    `edges` has two columns a and b of one orderable type, in any direction, repeats allowed;
    edges with a null end are ignored. An empty table gives an empty result.
    """
    edges = cut(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _digest(edges)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        edges = cut(_star(_star(edges, both_ways=True), both_ways=False))
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    # Every edge now points from a node to its component's smallest node.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
