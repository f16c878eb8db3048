"""Filters and projections of page logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tideline.schemas import VISIT_METRICS


def page_view_log(df):
    """Typed rows that are page views: no error and no start part."""
    kept = df.where(F.col("err").isNull() & F.col("start").isNull())
    return kept.drop("err", "start", "displays", "actions")


def session_starts(df):
    return df.where(F.col("page.last_page_id").isNull())


def filter_pages(df, page_ids=("home", "good_detail")):
    return df.where(F.col("page.page_id").isin(*page_ids))


def login_events(df):
    """Known users entering a session, or coming from the login page."""
    last_page = F.col("page.last_page_id")
    return df.where(F.col("common.uid").isNotNull() & (last_page.isNull() | (last_page == "login")))


def visit_metrics(df, kind):
    """One metric row per input row; ``kind`` is ``visitor``, ``bounce`` or ``page``."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    session = F.when(F.col("page.last_page_id").isNull(), one).otherwise(zero)
    values = {
        "visitor": (one, zero, zero, zero, zero),
        "bounce": (zero, zero, zero, zero, one),
        "page": (zero, session, one, F.col("page.during_time"), zero),
    }[kind]
    return df.select(
        F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
        *(v.alias(n) for v, n in zip(values, VISIT_METRICS)),
        F.col("ts"),
    )


def union_metrics(*frames):
    return reduce(lambda a, b: a.unionByName(b), frames)
