"""First and latest row per key.

The batch forms are ``min_by``/``max_by`` aggregates: a task keeps one row per key
before the shuffle, so a key that holds a third of the table sends one row per task,
where a ranked window would sort that third in one task.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.windows import WINDOW, tumbling
from tideline.streaming.daily import first_per_day_stream
from tideline.streaming.gap import first_after_silence_stream
from tideline.streaming.hold import latest_held_stream


def _best(df, keys, order, pick):
    row = pick(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select("_row.*")


def first_per_key(df, keys, order):
    """The row with the least ``order`` per key."""
    return _best(df, keys, order, F.min_by)


def latest_per_key(df, keys, order):
    """The row with the greatest ``order`` per key."""
    return _best(df, keys, order, F.max_by)


def first_per_day(df, keys, day="day", order=("ts", "arrival"), time="event_time", ttl_days=None):
    """First row per key and day.

    Rows that come back to an earlier day within the watermark do not count again.
    On a stream, ``ttl_days`` frees the state of keys idle that long in event time.
    """
    if df.isStreaming:
        return first_per_day_stream(df, keys, day, order, time, ttl_days).drop("is_new", "gap_days")
    return first_per_key(df, (*keys, day), order)


def first_per_key_ttl(df, keys, order, ttl_ms=5000):
    """First row per key; on a stream again after ``ttl_ms`` of silence of that key."""
    if df.isStreaming:
        return first_after_silence_stream(df, keys, order, ttl_ms)
    return first_per_key(df, keys, order)


def latest_per_key_hold(df, keys, order, hold_ms=5000):
    """Latest row per key; on a stream emitted ``hold_ms`` of wall clock after the first."""
    if df.isStreaming:
        return latest_held_stream(df, keys, order, hold_ms)
    return latest_per_key(df, keys, order)


def _per_key_in_window(df, keys, order, pick, time, size):
    """Built-in aggregate whose hold ends when the watermark passes the row's window.

    Usable in front of a windowed sum on a stream, as all versions of a detail share
    one event time. Emits the window column that the next step must group on.
    """
    row = pick(F.struct(*(c for c in df.columns if c != time)), F.struct(*order)).alias("_row")
    best = df.groupBy(tumbling(time, size).alias("window"), *keys).agg(row)
    return best.select(F.window_time("window").alias(time), "_row.*")


def latest_per_key_windowed(df, keys, order, time="event_time", size=WINDOW):
    if df.isStreaming:
        return _per_key_in_window(df, keys, order, F.max_by, time, size)
    return latest_per_key(df, keys, order)


def first_per_key_windowed(df, keys, order, time="event_time", size=WINDOW):
    if df.isStreaming:
        return _per_key_in_window(df, keys, order, F.min_by, time, size)
    return first_per_key(df, keys, order)
