"""Traffic jobs: page view, unique visitor and bounce details, and three summaries.

Every function takes and returns DataFrames, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import to_date_str
from tideline.operators.bounce import bounces
from tideline.operators.dedup import first_per_day
from tideline.operators.flags import dual_first_per_day, unique_and_returning
from tideline.operators.parse import page_view_text, parse_page_log, split_dirty
from tideline.operators.traffic import (
    filter_pages, login_events, session_starts, union_metrics, visit_metrics)
from tideline.operators.windows import (
    WINDOW, window_sum_all, window_sum_by, with_bounds, with_event_time)
from tideline.schemas import VISIT_METRICS


def page_view_detail(raw):
    """``(page views, dirty)`` as text, from raw log text.

    The page views are taken from the raw text, as that step parses it anyway and leaves
    out what is not an object.
    """
    _, dirty = split_dirty(raw)
    return page_view_text(raw), dirty


def unique_visitors(pages, tie=(), ttl_days=None):
    """First session start of the day per device, from typed page views.

    ``tie`` names columns that order rows of one millisecond.
    """
    starts = session_starts(pages)
    keyed = with_event_time(
        starts.withColumns({"mid": F.col("common.mid"), "day": to_date_str("ts")}), "ts", "2 seconds")
    first = first_per_day(keyed, ("mid",), "day", ("ts", *tie), ttl_days=ttl_days)
    return first.drop("mid", "day", "event_time")


def unique_visitor_detail(page_text, ttl_days=None):
    """Unique visitors as topic text, fields nobody declared included."""
    return unique_visitors(parse_page_log(page_text, keep=("value",)), ("value",), ttl_days).select("value")


def bounce_detail(page_text, within_ms=10_000):
    """Bounced session starts as topic text."""
    return bounces(parse_page_log(page_text, keep=("value",)), within_ms=within_ms).select("value")


def visit_summary(visitors, jumps, pages, size=WINDOW, stamp=True, delay="14 seconds"):
    """Visitors, sessions, page views, duration and bounces per version, channel and area.

    Each input has a watermark of its own, ``delay`` behind its latest row. The slowest one
    governs, so pages that run ahead close no window on visitors or bounces still to come.
    """
    timed = union_metrics(*(
        with_event_time(visit_metrics(rows, kind), "ts", delay)
        for rows, kind in ((visitors, "visitor"), (jumps, "bounce"), (pages, "page"))))
    summed = window_sum_by(timed, ("ar", "ch", "vc"), VISIT_METRICS, size=size)
    return with_bounds(summed, stamp)


def home_detail_summary(pages, tie=(), size=WINDOW, stamp=True, ttl_days=None):
    """Unique visitors of the home and detail pages."""
    rows = filter_pages(pages).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
        to_date_str("ts").alias("day"), "ts", *tie)
    timed = with_event_time(rows, "ts", "2 seconds")
    flags = dual_first_per_day(timed, order=("ts", *tie), ttl_days=ttl_days)
    return with_bounds(window_sum_all(flags, ("home_uv_ct", "good_detail_uv_ct"), size=size), stamp)


def login_flags(pages, tie=(), gap=8, ttl_days=None):
    """First login of the day per user, with unique and returning flags."""
    rows = login_events(pages).select(
        F.col("common.uid").alias("uid"), to_date_str("ts").alias("day"), "ts", *tie)
    timed = with_event_time(rows, "ts", "2 seconds")
    return unique_and_returning(timed, ("uid",), "day", gap, ("ts", *tie), ttl_days=ttl_days)


def login_summary(pages, tie=(), gap=8, size=WINDOW, stamp=True, ttl_days=None):
    """Users logging in, and users returning after ``gap`` or more days."""
    flags = login_flags(pages, tie, gap, ttl_days)
    return with_bounds(window_sum_all(flags, ("back_ct", "uu_ct"), size=size), stamp)
