"""Day-unique, new and returning flags.

Each starts from one row per key and day, so the per-key windows below see at most
one row for each day of the data.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tideline.functions.time import day_diff
from tideline.operators.dedup import first_per_day, first_per_key
from tideline.streaming.daily import first_per_day_stream


def _flag(condition):
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _daily(df, keys, day, order, time, ttl_days):
    """First rows of the day with ``is_new`` and ``gap_days`` since the day before."""
    if df.isStreaming:
        return first_per_day_stream(df, keys, day, order, time, ttl_days)
    first = first_per_key(df, (*keys, day), order)
    by_day = Window.partitionBy(*keys).orderBy(day)
    before = F.lag(day).over(by_day)
    return (first.withColumn("_before", before)
            .withColumn("is_new", F.col("_before").isNull())
            .withColumn("gap_days", day_diff(day, "_before").cast("bigint"))
            .drop("_before"))


def unique_and_new(df, keys, day="day", order=("ts", "arrival"), time="event_time", ttl_days=None):
    """First row per key and day with ``unique_user_ct`` and ``new_user_ct`` flags."""
    rows = _daily(df, keys, day, order, time, ttl_days)
    return (rows.withColumn("unique_user_ct", F.lit(1).cast("bigint"))
            .withColumn("new_user_ct", _flag(F.col("is_new")))
            .drop("is_new", "gap_days"))


def unique_and_returning(df, keys, day="day", gap=8, order=("ts", "arrival"), time="event_time",
                         ttl_days=None):
    """First row per key and day with ``uu_ct``, and ``back_ct`` after ``gap`` or more days."""
    rows = _daily(df, keys, day, order, time, ttl_days)
    return (rows.withColumn("back_ct", _flag(F.coalesce(F.col("gap_days") >= gap, F.lit(False))))
            .withColumn("uu_ct", F.lit(1).cast("bigint"))
            .drop("is_new", "gap_days"))


def dual_first_per_day(df, key="mid", page="page_id", day="day", order=("ts", "arrival"),
                       time="event_time", ttl_days=None, pages=("home", "good_detail")):
    """Independent day-unique flags of two pages for one key."""
    first = first_per_day(df, (key, page), day, order, time, ttl_days)
    return (first.withColumn("home_uv_ct", _flag(F.col(page) == pages[0]))
            .withColumn("good_detail_uv_ct", _flag(F.col(page) == pages[1])))
