"""Edges followed forward and backward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.session import settled

SLICES = 32  # of the edges of each node, so that those of a hub are spread; nodes, which are narrow, are given to each


def _slice(other_end: str) -> Column:
    return F.pmod(F.xxhash64(other_end), F.lit(SLICES)).cast("int")


def _in_slices(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))


def degrees(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """node, n_out, n_in: of distinct neighbours. Edges with a null end are left out; self-edges count on both sides."""
    pairs = edges.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(F.col(source).alias("s"), F.col(target).alias("t")).distinct()
    sides = pairs.select(F.col("s").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionAll(pairs.select(F.col("t"), F.lit(0), F.lit(1)))
    return sides.groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def two_hop_counts(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """node, n_paths: the number of ways of two distinct edges that begin at a node.

    The middle node's edges are counted before the join, so a hub costs one row, not the product of its edges; the edges
    that lead to it are joined in slices.
    """
    pairs = edges.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(F.col(source).alias("s"), F.col(target).alias("t")).distinct()
    onward = pairs.groupBy(F.col("s").alias("t")).agg(F.count("*").alias("n"))
    return pairs.withColumn("slice", _slice("s")).join(_in_slices(onward), ["t", "slice"]).groupBy(F.col("s").alias("node")).agg(F.sum("n").alias("n_paths"))


def reach(edges: DataFrame, start: DataFrame, most_hops: int, source: str = "source", target: str = "target") -> DataFrame:
    """node, hops: every node that can be reached from the nodes of `start` (column node) in at most `most_hops`
    edges, with the fewest. The frontier holds each node once and is cut from its history after each hop; the edges of a
    node are followed in slices."""
    pairs = edges.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(F.col(source).alias("node"), F.col(target).alias("t")).distinct().withColumn("slice", _slice("t"))
    seen = settled(start.select("node").where("node is not null").distinct().withColumn("hops", F.lit(0)))
    frontier = seen
    for hop in range(1, most_hops + 1):
        found = pairs.join(_in_slices(frontier.select("node")), ["node", "slice"], "left_semi").select(F.col("t").alias("node")).distinct()
        frontier = settled(found.join(seen, "node", "left_anti").withColumn("hops", F.lit(hop)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen
