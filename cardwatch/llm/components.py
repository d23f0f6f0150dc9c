"""Connected components of an edge table by alternating star contractions.

Every round is two joins and two aggregations over the edges, each written to the shared folder, so a
lost executor costs at most one round. A hub only meets a minimum, which combines before the shuffle;
its join partition is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import discard, saved


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node move to the smallest of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return (
        near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.union(own).where("a <> b").distinct()


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; the root is the least node reached.

    Nodes may be of any type that has an order. Loops, repeated edges and edges in either direction are allowed; no
    edge gives no row.
    """
    at = saved(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(),
        "edges",
    )
    before = _state(at)
    while before[0]:
        old, at = at, saved(_small_star(_large_star(at)), "edges")
        after = _state(at)
        discard(old)
        if after == before:
            break
        before = after
    roots = at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return at.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
