"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouping (partially aggregated) and a join against a stored table, so a
node with very many links is split over tasks; nothing is collected.  The number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v) with u > v.  Large star: every larger neighbour of u is linked to
    the least of u's neighbourhood; small star: u and its smaller neighbours are."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
    # the same answer whatever the sizes: always a shuffled join, split where a node is hot
    joined = both.join(least.hint("merge"), "u")
    if large:
        pairs = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pairs = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return pairs.filter("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of all nodes in ``links``; a component is its least node.
    Links may repeat, point either way or join a node to itself; nodes are never null."""
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "cc-edges")
    while True:
        after = stored(_star(stored(_star(edges, True), "cc-large"), False), "cc-small")
        # done when every node hangs on one root and no root hangs on another node
        n, same = after.count(), after.join(edges.hint("merge"), ["u", "v"]).count()
        if n == same and n == edges.count():
            break
        edges = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
