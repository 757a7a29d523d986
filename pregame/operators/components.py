"""Connected components of a distributed edge table.

Alternating large-star and small-star steps: each step joins the edges with
the smallest neighbour of every node, found by a pre-aggregated ``min``, so no
neighbour list is ever gathered and a hub's edges stay spread over the tasks of
a skew join.  The number of rounds grows with the logarithm of the longest
path.  Every round is checkpointed.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import kept


def _both(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, in one pass."""
    return edges.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                         F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long node ids -> (node, root): root is the smallest node id of the
    node's component.  Nodes without an edge are absent."""
    e = kept(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # large star: neighbours larger than u move to u's smallest neighbour (or u)
        n = _both(e)
        m = n.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = n.filter("v > u").join(m, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: u and its smaller neighbours move to the smallest of them
        m = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(m, "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                            F.struct(F.col("a"), F.col("m").alias("b")))))
                 .filter("a <> b").distinct())
        nxt = kept(small)
        # done when every node points at one root, and no root points anywhere
        ends = nxt.select(F.inline(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("out")),
                                           F.struct(F.col("b").alias("n"), F.lit(0).alias("out")))))
        loose = ends.groupBy("n").agg(F.sum("out").alias("outs"), F.min("out").alias("least"))
        if loose.filter("outs > 1 OR (outs = 1 AND least = 0)").isEmpty():
            return nxt.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                nxt.select(F.col("b"), F.col("b")).distinct())
        e = nxt
