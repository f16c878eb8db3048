"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.llm.common import checkpointed, quoted, without, word_count

ADDED = ("size", "source_size", "target", "rate", "copies")
# A table of at most this many sources is broadcast (some tens of bytes each).
BROADCAST_SOURCES = 20_000


def source_targets(sizes, weights=(5, 2, 1), most=3):
    """Per source its size, target and repetition rate, from rows of ``__source`` and ``size``.

    Sources in code point order, null last, take the weights in turn and share the total.
    No target exceeds ``most`` times the source's size; the excess goes to the others by
    weight until none is above. With the sources in order of size per weight, the capped
    ones are a prefix, and the share of the others is the largest share that any prefix
    leaves. The table has one row per source, so its ordering fits one task.
    """
    total = sizes.groupBy("__source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = total.select("__source", "source_size", turn.cast("long").alias("__weight"),
                        (F.col("source_size") * most).alias("__cap"))
    order = Window.orderBy(F.col("__cap") / F.col("__weight"), F.col("__source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum("__cap").over(before), F.lit(0))
    left = F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(before), F.lit(0))
    rows = rows.withColumn("__share", (F.sum("source_size").over(everything) - capped) / left)
    target = F.least(F.col("__cap").cast("double"), F.max("__share").over(everything) * F.col("__weight"))
    return rows.select("__source", "source_size", target.alias("target"),
                       F.when(F.col("source_size") > 0, target / F.col("source_size"))
                       .otherwise(F.lit(0.0)).alias("rate"))


def plan_mix(docs, text="text", source="source", id="doc_id", weights=(5, 2, 1), most=3, seed="mix"):
    """Add to every document its ``size`` in words, ``source_size``, ``target``, ``rate`` and ``copies``.

    ``copies`` is floor(rate) plus one with probability equal to the fraction, drawn from a
    hash of the seed and the identifier, so a rerun draws the same. Null text has size 0.
    Documents of a source without words get no copies. Rows with one identifier share
    their draw. Columns of ``docs`` named like an added column are replaced.
    """
    base = without(docs, *ADDED)
    rows = base.select("*", F.col(source).alias("__source"), F.col(id).cast("string").alias("__id"),
                       word_count(F.col(text)).alias("size"))
    targets = checkpointed(source_targets(rows, weights, most))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    targets = targets.withColumnRenamed("__source", "__of")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce("__id", F.lit("")))
    # 52 bits of the hash are exact in a double.
    draw = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    floor = F.floor("rate")
    return (rows.join(targets, F.col("__source").eqNullSafe(F.col("__of")))
            .withColumn("copies", floor + F.when(draw < F.col("rate") - floor, 1).otherwise(0))
            .select(*quoted(base.columns), *ADDED))


def mix(docs, **options):
    """The mixed documents: every row of ``docs`` as often as planned, with its columns."""
    planned = plan_mix(docs.select(F.struct(*quoted(docs.columns)).alias("row"), *_keys(docs, options)), **options)
    return (planned.filter("copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))


def _keys(docs, options):
    return [docs[options.get(k, v)] for k, v in (("text", "text"), ("source", "source"), ("id", "doc_id"))]
