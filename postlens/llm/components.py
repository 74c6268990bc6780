"""Connected components of an undirected graph, as alternating large-star and small-star joins.

Each round points every node at smaller neighbours of its neighbourhood: the number of edges never
grows, and the number of rounds is logarithmic in practice even for long chains. A node's smallest
neighbour is a partial aggregate, so a hub with a third of all edges is reduced before the shuffle.
The minima are written before they are joined back to the edges: both sides of that join are then
plain shuffles, which adaptive execution splits where a hub makes them uneven.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import cut


def _small_star(edges: DataFrame) -> DataFrame:
    """Connects each node's smaller neighbours, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = cut(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Connects each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge to another; the component is its smallest node.

    ``edges`` has the columns ``u`` and ``v`` of one orderable type; loops, repeats and nulls are
    ignored.
    """
    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        now = cut(_small_star(cut(_large_star(now), "star")), "star")
        # Unchanged counts and sums of both ends over a round mean that every edge is a star's.
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(members.select(F.col("component").alias("node"), "component").distinct())
