"""Bounced session starts on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F


def bounces_stream(df, key, ts, last_page, arrival, within_ms, delay):
    """The bounced start rows, out of built-in aggregates.

    A key's rows go into windows twice ``within_ms`` long that begin every ``within_ms``, so
    each start has all rows that can decide it in the window that it is in the first half
    of. A window's rows are decided together when the watermark passes its end: matched and
    timed-out starts alike, and at most ``within_ms`` apart, so that watermarks behind this
    query need not reach further back. Of rows that only decide others no more is kept than
    their order. A row without time decides nothing and is no bounce.
    """
    rows = df.select(
        F.col(key).alias("_key"),
        F.col(ts).alias("_ms"),
        (F.col(arrival) if arrival else F.lit(0)).cast("bigint").alias("_arrival"),
        F.col(last_page).isNull().alias("_start"),
        F.struct(*df.columns).alias("_full"),
        F.timestamp_millis(ts).alias("_time"),
    ).withWatermark("_time", delay)
    window = F.window("_time", f"{2 * within_ms} milliseconds", f"{within_ms} milliseconds").alias("_window")
    rows = rows.select("_key", "_ms", "_arrival", "_start", "_full", window)
    own = F.col("_ms") - F.unix_millis("_window.start") < within_ms
    mine = F.when(F.col("_start") & own, F.col("_full")).alias("_row")
    held = rows.groupBy("_key", "_window").agg(
        F.collect_list(F.struct("_ms", "_arrival", "_start", mine)).alias("_rows"))

    # The rows themselves may hold what has no order, so their places are sorted.
    places = F.transform("_rows", lambda r, n: F.struct(
        r["_ms"].alias("ms"), r["_arrival"].alias("arrival"), n.alias("place"), r["_start"].alias("start")))

    def bounced(row, n):
        after = F.get("_sorted", n + 1)
        alone = after.isNull() | after["start"] | (after["ms"] - row["ms"] >= within_ms)
        return F.when(alone, F.get("_rows", row["place"])["_row"])

    decided = held.withColumn("_sorted", F.array_sort(places)).select(
        F.explode(F.filter(F.transform("_sorted", bounced), lambda r: r.isNotNull())).alias("_row"))
    return decided.select("_row.*")
