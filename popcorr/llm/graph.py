"""Connected components of an edge table as DataFrame jobs (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popcorr.session import cut_lineage, release

#: Edges up to which the least neighbour of every node is broadcast (two nodes each).
BROADCAST_EDGES = 1_000_000


def _star(edges: DataFrame, large: bool, small_enough: bool) -> DataFrame:
    """One star step on edges (a > b): every neighbour (larger ones, or the smaller ones) to the least."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # a hub's edges stay where they are, or are a plain join of two exchanges, which adaptive execution splits
    least = F.broadcast(least) if small_enough else cut_lineage(least, "components_least")
    joined = both.join(least, "a")
    if large:
        return joined.where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))).where("a <> b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the least node that edges (a, b) reach; nodes without an edge are absent.

    A round halves the depth of the trees, so a few rounds end it; each is
    written to the shared folder, and a hash of the edge set tells when it is
    stable.  Minima are taken before the shuffle, so a hub is no hot key there.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark = cut_lineage(now, "components"), None
    while True:
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark, old, small = new, now, new[0] <= BROADCAST_EDGES
        now = cut_lineage(_star(_star(now, True, small), False, small).distinct(), "components")
        release(old)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
