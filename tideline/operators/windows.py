"""Event time, tumbling windows and windowed sums.

All sums are partial/final aggregates, so each task combines its rows before the
shuffle and a hot group costs one row per task. Amounts are summed as decimals.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.scalars import MONEY
from tideline.functions.time import DATE_TIME, ms_to_timestamp, processing_millis, text_to_timestamp

WINDOW = "10 seconds"


def with_event_time(df, column="ts", delay="2 seconds", name="event_time"):
    """Add the event time of ``column`` (epoch ms, date-time text or timestamp).

    On a stream the column also carries the watermark; on a batch nothing else changes.
    """
    kind = dict(df.dtypes)[column]
    if kind == "string":
        value = text_to_timestamp(column)
    elif kind in ("bigint", "int"):
        value = ms_to_timestamp(column)
    else:
        value = F.col(column).cast("timestamp")
    out = df.withColumn(name, value)
    return out.withWatermark(name, delay) if df.isStreaming else out


def tumbling(time="event_time", size=WINDOW):
    """Epoch-aligned ``[start, end)`` window."""
    return F.window(time, size)


def with_bounds(df, stamp=True):
    """Replace ``window`` by text bounds, and add the wall-clock ``ts``."""
    bounds = [F.date_format(f"window.{edge}", DATE_TIME).alias(name)
              for edge, name in (("start", "stt"), ("end", "edt"))]
    rest = [c for c in df.columns if c != "window"]
    return df.select(*bounds, *rest, *([processing_millis().alias("ts")] if stamp else []))


def window_sum_by(df, keys, metrics, time="event_time", size=WINDOW):
    """Sums per window and key."""
    return df.groupBy(tumbling(time, size).alias("window"), *keys).agg(
        *(F.sum(m).alias(m) for m in metrics))


def window_sum_all(df, metrics, time="event_time", size=WINDOW):
    """Sums per window over everything."""
    return window_sum_by(df, (), metrics, time, size)


def window_distinct_sum(df, keys, item="order_id", amount="order_amount", count_as="order_count",
                        time="event_time", size=WINDOW):
    """Exact number of different items, and sum of the amount, per window and key.

    First one row per item, then one per key: no set of items is ever held in one
    place, and the same two steps run on a stream, where the second uses the window
    of the first. A null item counts as one item.
    """
    per_item = df.groupBy(tumbling(time, size).alias("window"), *keys, item).agg(
        F.sum(F.col(amount).cast(MONEY)).alias("_amount"))
    again = tumbling("window", size) if df.isStreaming else F.col("window")
    return per_item.groupBy(again.alias("window"), *keys).agg(
        F.count(F.lit(1)).alias(count_as),
        F.sum("_amount").cast("double").alias(amount),
    )
