"""Unbounded left join of two change streams, kept as an upsert table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.joins import left_join
from tideline.sinks.upsert import read_upsert, upsert_batch
from tideline.streaming.run import start_query


def tagged_sides(a, b):
    """The rows ``id, name_a, seq`` and ``id, name_b, seq`` of both sides as one stream."""
    return (a.select("id", F.col("name_a").alias("name"), "seq", F.lit("a").alias("side"))
            .unionByName(b.select("id", F.col("name_b").alias("name"), "seq", F.lit("b").alias("side"))))


def left_join_batch(root):
    """Micro-batch step: log both sides, then join again the keys that changed.

    ``seq`` orders the changes of a key; the last one wins, whatever its text.

    Only rows of those keys are taken from the logs, so a micro-batch shuffles in
    proportion to its own size.
    """
    def each_batch(rows, batch_id):
        spark = rows.sparkSession
        for side in ("a", "b"):
            mine = rows.where(F.col("side") == side).select("id", F.col("name").alias(f"name_{side}"), "seq")
            upsert_batch(mine, f"{root}/{side}", ("id",), ("seq",), batch_id)
        changed = rows.select("id").distinct()
        a, b = (read_upsert(spark, f"{root}/{side}", ("id",), only=changed).drop("seq") for side in ("a", "b"))
        # One row per key on either side, so the joined rows need no order.
        upsert_batch(left_join(a, b), f"{root}/joined", ("id_a",), ("id_a",), batch_id)
    return each_batch


def left_join_upsert(a, b, root, checkpoint, trigger=None):
    """Start the join of two streams; read the result with ``read_upsert(..., ("id_a",))``."""
    return start_query(tagged_sides(a, b), checkpoint, each_batch=left_join_batch(root), trigger=trigger)
