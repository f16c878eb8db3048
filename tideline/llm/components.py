"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, written


def components(edges):
    """Label the nodes of ``edges`` (``a``, ``b``) with the smallest node they reach.

    Returns ``node`` and ``label``, for nodes that have an edge to another. Every round
    hangs neighbours on the smallest node around them; rounds grow with the logarithm of
    the longest path. A node with very many neighbours is reduced by partial aggregates;
    the minima are written, so the join has an exchange on both sides and can split it.
    """
    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .distinct())
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                now.select(F.col("b"), F.col("b"))).distinct()
        seen = state
        now = checkpointed(_small_star(_large_star(now)))


def _large_star(edges):
    """Connect the larger neighbours of every node with the smallest node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = written(both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m")), "least")
    return (both.join(least, F.col("a") == F.col("of")).filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(edges):
    """Connect the smaller neighbours of every node, and the node, with the smallest."""
    least = written(edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m")), "least")
    return (edges.join(least, F.col("a") == F.col("of")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("of", "m")).distinct())
