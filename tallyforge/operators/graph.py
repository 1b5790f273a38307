"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node near it (pairs are (larger, smaller))."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def star_rounds(edges: DataFrame) -> tuple[DataFrame, int]:
    """((a, b): every linked id beside the smallest id of its component, rounds taken).

    Large-star and small-star steps in turn: both keep the components and never add edges, and the number of rounds
    grows with the logarithm of the longest path, so there is no limit on rounds. Every half round is written to the
    shared folder, so a lost executor costs at most one. It ends when a round leaves the pairs as they were.
    """
    far = F.greatest("a", "b")
    pairs = stored(edges.filter("a <> b").select(far.alias("a"), F.least("a", "b").alias("b")).distinct(), "pairs")
    n, rounds = pairs.count(), 0
    while n:
        rounds += 1
        after = stored(_small_star(stored(_large_star(pairs), "stars")), "pairs")
        m = after.count()
        if m == n and after.join(pairs, ["a", "b"], "left_anti").isEmpty():
            break
        pairs, n = after, m
    return pairs, rounds


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable from each of `nodes` (id) over `edges` (a, b)."""
    pairs, _ = star_rounds(edges)
    tied = pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return nodes.select("id").join(tied, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
