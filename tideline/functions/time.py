"""Time text and epoch milliseconds, all in the session time zone."""

from __future__ import annotations

from pyspark.sql import functions as F

# The two text layouts of dates and times.
DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def text_to_timestamp(text):
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp; null when it does not parse."""
    return F.try_to_timestamp(_col(text), F.lit(DATE_TIME))


def to_ts(text, full=False):
    """Date text, or with ``full`` date-time text, to epoch milliseconds."""
    return F.unix_millis(F.try_to_timestamp(_col(text), F.lit(DATE_TIME if full else DATE)))


def ms_to_timestamp(ms):
    return F.timestamp_millis(_col(ms))


def to_date_str(ms):
    return F.date_format(ms_to_timestamp(ms), DATE)


def to_ymdhms(ms):
    return F.date_format(ms_to_timestamp(ms), DATE_TIME)


def row_time(text):
    """Row time text such as ``2022-04-01 10:20:47.41Z``; whole seconds parse as well."""
    return _col(text).try_cast("timestamp")


def compare_ltz3(a, b):
    """-1, 0 or 1 for the order of two row times at millisecond precision."""
    delta = F.unix_millis(row_time(a)) - F.unix_millis(row_time(b))
    return F.signum(delta).cast("int")


def day_diff(later, earlier):
    return F.datediff(_col(later), _col(earlier))


def date_part_of(text):
    return F.split(_col(text), " ")[0]


def processing_time():
    return F.current_timestamp()


def processing_millis():
    return F.unix_millis(F.current_timestamp())
