"""Bounced session starts.

A session start (no last page) is a bounce when its key's next row is missing, is a
start as well, or comes ``within_ms`` or later. Only the next ``within_ms`` of a key
matter, so a key's rows are cut into time slices and the head of each slice is also
given to the slice before. A hot key then spreads over as many tasks as it has slices.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tideline.streaming.bounce import bounces_stream


def sliced(df, key, ts, last_page, arrival, within_ms, slices):
    """``_key, _ms, _arrival, _start, _slice, _row``; ``_row`` is set on own-slice starts."""
    width = within_ms * slices
    ms = F.col(ts)
    begin = ms - F.pmod(ms, F.lit(width))
    in_head = F.pmod(ms, F.lit(width)) < within_ms
    rows = df.select(
        F.col(key).alias("_key"),
        ms.alias("_ms"),
        (F.col(arrival) if arrival else F.lit(0)).cast("bigint").alias("_arrival"),
        F.col(last_page).isNull().alias("_start"),
        F.struct(*df.columns).alias("_full"),
        F.explode(F.when(in_head, F.array(begin, begin - width)).otherwise(F.array(begin))).alias("_slice"),
    )
    own = F.col("_ms") - F.col("_slice") < width
    return rows.select("_key", "_ms", "_arrival", "_start", "_slice",
                       F.when(F.col("_start") & own, F.col("_full")).alias("_row"))


def bounces(df, key="common.mid", ts="ts", last_page="page.last_page_id", arrival=None,
            within_ms=10_000, slices=6, delay="2 seconds"):
    """The bounced start rows of ``df``, each once, with its own columns.

    On a stream slices are one ``within_ms`` long, and ``delay`` is the watermark's.
    """
    if df.isStreaming:
        return bounces_stream(df, key, ts, last_page, arrival, within_ms, delay)
    rows = sliced(df, key, ts, last_page, arrival, within_ms, slices)
    order = Window.partitionBy("_key", "_slice").orderBy("_ms", "_arrival")
    rows = rows.withColumn("_next", F.lead(F.struct("_ms", "_start")).over(order))
    bounced = (F.col("_next").isNull() | F.col("_next._start")
               | (F.col("_next._ms") - F.col("_ms") >= within_ms))
    return rows.where(F.col("_row").isNotNull() & bounced).select("_row.*")
