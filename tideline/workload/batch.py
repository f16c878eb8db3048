"""Registered queries over the driver tables, one or more per operator."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import scalars, time as times
from tideline.operators import cdc, dedup, flags, joins, parse, traffic as ops
from tideline.operators.bounce import bounces
from tideline.operators.lookup import lookup_chain
from tideline.operators.windows import (
    window_distinct_sum, window_sum_by, with_bounds, with_event_time)
from tideline.plans import traffic, trade
from tideline.plans.dimensions import route_batch, routed_changes
from tideline.plans.left_join import left_join_batch, tagged_sides
from tideline.schemas import (
    ORDER_ACTIVITY_CDC, ORDER_COUPON_CDC, ORDER_DETAIL_CDC, ORDER_DETAIL_COLUMNS, ORDER_INFO_CDC,
    PAGE_LOG_TEXT, PAY_DETAIL_COLUMNS, USER_SPU_SUMMARY, dimension_schema, text_struct)
from tideline.session import REMOVE_SHUFFLES, setting, work_dir
from tideline.sinks.dimension import compact_dimension, read_dimension
from tideline.sinks.summary import read_summary, write_summary
from tideline.sinks.topics import write_json_topic
from tideline.sinks.upsert import read_upsert, upsert_topic
from tideline.sources.topics import read_changelog, read_json_stream
from tideline.workload import inputs
from tideline.workload.inputs import TIE

DAY = "1 day"
MONTH = "30 days"
HOUR_MS = 3_600_000


def _flat(pages):
    return pages.select("arrival", F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"),
                        F.col("page.page_id").alias("page_id"),
                        F.col("page.last_page_id").alias("last_page_id"),
                        F.col("page.during_time").alias("during_time"), "ts")


# --- parsing, filters -----------------------------------------------------------------

def parse_and_split_dirty(spark, sf):
    good, dirty = parse.split_dirty(inputs.raw_log(spark, sf))
    rows = parse.parse_page_log(good)
    return (rows.select(F.lit("good").alias("kind"),
                        F.concat_ws("@", scalars.json_path("common", "mid"), "ts").alias("text"))
            .unionByName(dirty.select(F.lit("dirty").alias("kind"), F.col("value").alias("text"))))


def page_view_log(spark, sf):
    """Page rows as text, read back: undeclared keys are still there, lists are gone."""
    pages, _ = traffic.page_view_detail(inputs.raw_log(spark, sf))
    shape = T.StructType([*PAGE_LOG_TEXT.fields, *text_struct("offset", "displays", "actions").fields])
    return parse.parse_json(pages, shape).select(
        scalars.number_of("offset", "bigint").alias("arrival"), "displays", "actions",
        F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"),
        F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"),
        scalars.number_of("page.during_time", "bigint").alias("during_time"),
        scalars.number_of("ts", "bigint").alias("ts"))


def page_view_typed(spark, sf):
    good = parse.parse_page_log(inputs.raw_log(spark, sf))
    pages = ops.page_view_log(good)
    return pages.select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")


def session_starts(spark, sf):
    return _flat(ops.session_starts(inputs.page_log(spark, sf)))


def filter_pages(spark, sf):
    return _flat(ops.filter_pages(inputs.page_log(spark, sf)))


def login_events(spark, sf):
    return _flat(ops.login_events(inputs.page_log(spark, sf)))


# --- traffic --------------------------------------------------------------------------

def unique_visitor_daily(spark, sf):
    return _flat(traffic.unique_visitors(inputs.page_log(spark, sf), ("arrival",)))


def bounces_10s(spark, sf):
    return _flat(bounces(inputs.page_log(spark, sf), arrival="arrival"))


def bounces_1h(spark, sf):
    return _flat(bounces(inputs.page_log(spark, sf), arrival="arrival", within_ms=HOUR_MS))


def visit_summary(spark, sf, size="10 seconds"):
    pages = inputs.page_log(spark, sf)
    visitors = traffic.unique_visitors(pages, ("arrival",))
    jumps = bounces(pages, arrival="arrival")
    return traffic.visit_summary(visitors, jumps, pages, size, stamp=False)


def visit_summary_1d(spark, sf):
    return visit_summary(spark, sf, DAY)


def home_detail_uv(spark, sf, size="10 seconds"):
    return traffic.home_detail_summary(inputs.page_log(spark, sf), ("arrival",), size, stamp=False)


def home_detail_uv_1d(spark, sf):
    return home_detail_uv(spark, sf, DAY)


def login_returning(spark, sf, gap=8):
    return traffic.login_summary(inputs.page_log(spark, sf), ("arrival",), gap, stamp=False)


def login_returning_gap3(spark, sf):
    return login_returning(spark, sf, 3)


# --- change log -----------------------------------------------------------------------

def _view(table, columns):
    def query(spark, sf):
        return cdc.cdc_view(inputs.trade_changelog(spark, sf), table, columns, "shop")
    return query


def payment_success_view(spark, sf):
    return cdc.payment_success_view(inputs.trade_changelog(spark, sf))


def wide_details(spark, sf):
    joined = trade.joined_changes(inputs.trade_changelog(spark, sf), database="shop")
    return trade.name_source_type(joined, inputs.base_dic(spark, sf))


def order_detail_upsert(spark, sf):
    """The joined details logged as an upsert table and read back: one row per id.

    They are stored before the last row per id is looked for, so that the shuffle files of the
    joins are gone by then.
    """
    path = work_dir(spark, "order-detail")
    joined = trade.joined_changes(inputs.trade_changelog(spark, sf), database="shop", keep=("seq",))
    rows = trade.name_source_type(joined, inputs.base_dic(spark, sf), ("version",))
    with setting(spark, REMOVE_SHUFFLES, "true"):
        rows.write.parquet(f"{path}/joined", compression="zstd")
        upsert_topic(spark.read.schema(rows.schema).parquet(f"{path}/joined"), path, ("id",), ("version",))
    return read_upsert(spark, path, ("id",)).select(*ORDER_DETAIL_COLUMNS)


def pay_detail_success(spark, sf):
    details = inputs.order_detail(spark, sf)
    rows = trade.pay_detail(inputs.trade_changelog(spark, sf), details, inputs.base_dic(spark, sf))
    return rows.select(*PAY_DETAIL_COLUMNS, "row_op_ts")


def latest_per_detail(spark, sf):
    rows = inputs.order_detail(spark, sf).withColumn("version", times.row_time("row_op_ts"))
    return dedup.latest_per_key_hold(rows, ("id",), ("version", *TIE)).drop("version", *TIE)


def first_per_detail(spark, sf):
    rows = inputs.order_detail(spark, sf).withColumn("version", times.row_time("row_op_ts"))
    return dedup.first_per_key_ttl(rows, ("id",), ("version", *TIE)).drop("version", *TIE)


def left_join_upsert(spark, sf):
    """Orders left-joined with the part of the customers that has a positive balance, upserted."""
    root = work_dir(spark, "left-join")
    left_join_batch(root)(tagged_sides(*join_sides(spark, sf)), 0)
    return read_upsert(spark, f"{root}/joined", ("id_a",))


def join_sides(spark, sf):
    """Changes of both sides, several a key: ``a``: orders, whose texts fall as they go on.

    ``b``: customers with a positive balance, some with a later change to empty text.
    """
    a = inputs.table(spark, sf, "orders").select(
        inputs.text("o_custkey").alias("id"),
        F.format_string("%012d", F.lit(999_999_999_999) - F.col("o_orderkey")).alias("name_a"),
        inputs.sequence(F.col("o_orderkey")).alias("seq"))
    customers = inputs.table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    key, first, second = inputs.text("c_custkey").alias("id"), inputs.sequence(F.lit(0)), inputs.sequence(F.lit(1))
    b = customers.select(key, F.col("c_name").alias("name_b"), first.alias("seq")).unionByName(
        customers.where(F.col("c_custkey") % 5 == 0).select(key, F.lit("").alias("name_b"), second.alias("seq")))
    return a, b


# --- trade summaries ------------------------------------------------------------------

def province_orders(spark, sf, size="10 seconds"):
    return trade.province_summary(inputs.order_detail(spark, sf), inputs.provinces(spark, sf), TIE, size,
                                  stamp=False)


def province_orders_30d(spark, sf):
    return province_orders(spark, sf, MONTH)


def province_orders_drop(spark, sf):
    return trade.province_summary(inputs.order_detail(spark, sf), inputs.provinces(spark, sf), TIE, MONTH,
                                  stamp=False, on_missing="drop")


def user_spu_orders(spark, sf, size="10 seconds"):
    tie = ("row_op_ts", *TIE)
    return trade.user_spu_summary(inputs.order_detail(spark, sf), inputs.spu_dims(spark, sf), tie, size,
                                  stamp=False)


def user_spu_orders_30d(spark, sf):
    return user_spu_orders(spark, sf, MONTH)


def paying_users(spark, sf, size="10 seconds"):
    return trade.payer_summary(inputs.pay_detail(spark, sf), TIE, size, stamp=False)


def paying_users_1d(spark, sf):
    return paying_users(spark, sf, DAY)


# --- dimensions -----------------------------------------------------------------------

def config_routing(spark, sf):
    config = cdc.latest_config(inputs.config_envelopes(spark))
    rows = routed_changes(inputs.dimension_changelog(spark, sf), config)
    pairs = F.transform(F.array_sort(F.map_keys("data")),
                        lambda k: F.concat_ws("=", k, F.try_element_at("data", k)))
    return rows.select("sink_table", "type", F.concat_ws(";", pairs).alias("data"))


def _snapshot(spark, sf, compact):
    """All changes routed into dimension logs in three batches, then read per table."""
    config = cdc.latest_config(inputs.config_envelopes(spark))
    changes = inputs.dimension_changelog(spark, sf)
    root = work_dir(spark, "dims")
    shapes = {sink: dimension_schema(columns, pk, extend) for _, sink, columns, pk, extend in inputs.ROUTES}
    for step in range(3):
        route_batch(spark, changes.where(F.col("xid") == step), config, root, step, ("seq",))
        if compact and step == 1:
            for sink, shape in shapes.items():
                compact_dimension(spark, root, sink, shape)
    out = None
    for sink, shape in shapes.items():
        rows = read_dimension(spark, root, sink, shape)
        rows = rows.select(F.lit(sink).alias("sink_table"), "id", *(
            (F.col(c) if c in shape.names else F.lit(None).cast("string")).alias(c)
            for c in ("name", "sku_name", "tm_id", "spu_id")))
        out = rows if out is None else out.unionByName(rows)
    return out


def dimension_snapshot(spark, sf):
    return _snapshot(spark, sf, compact=False)


def dimension_compacted(spark, sf):
    return _snapshot(spark, sf, compact=True)


def nation_region_lookup(spark, sf, on_missing="keep"):
    """Suppliers with nation and region by chained lookups, some keys missing."""
    dims = inputs.spu_dims(spark, sf)
    suppliers = inputs.table(spark, sf, "supplier").select(
        "s_suppkey", inputs.text("s_nationkey").alias("category2_id"))
    return lookup_chain(suppliers, [
        (dims["base_category2"], "category2_id", {"nation": "name", "category1_id": "category1_id"}),
        (dims["base_category1"], "category1_id", {"region": "name"}),
    ], on_missing)


def nation_region_lookup_drop(spark, sf):
    return nation_region_lookup(spark, sf, "drop")


# --- scalars, sinks -------------------------------------------------------------------

def compare_row_time(spark, sf):
    """Each line's ship time against its order's, as row time texts of several forms."""
    lines = inputs.order_lines(spark, sf)
    a = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
                 F.element_at(F.array(F.lit("Z"), F.lit(".41Z"), F.lit(".041Z"), F.lit(".302Z")),
                              (F.col("l_linenumber") % 4 + 1).cast("int")))
    b = F.concat(F.date_format("created", "yyyy-MM-dd HH:mm:ss"), F.lit(".041Z"))
    same = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit(".041Z"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        times.compare_ltz3(a, b).cast("bigint").alias("against_order"),
        times.compare_ltz3(a, same).cast("bigint").alias("against_same_second"))


def time_text(spark, sf):
    orders = inputs.order_times(spark, sf)
    ms = F.unix_millis("created")
    whole = times.to_ymdhms(ms)
    return orders.select(
        "o_orderkey", ms.alias("ms"), whole.alias("date_time"), times.to_date_str(ms).alias("date"),
        times.date_part_of(whole).alias("date_part"),
        times.to_ts(whole, full=True).alias("full_ms"),
        times.to_ts(times.to_date_str(ms)).alias("day_ms"),
        times.to_ts(F.col("o_orderpriority"), full=True).alias("bad_ms"),
        times.day_diff(F.col("created"), F.lit("1995-01-01").cast("date")).cast("bigint").alias("days"))


def summary_sink_columns(spark, sf):
    """A written summary: columns in sink order, without transient or wall-clock ones."""
    totals = user_spu_orders_30d(spark, sf).withColumn("sku_id", F.lit("any"))
    rows = totals.withColumn("ts", times.processing_millis())
    path = work_dir(spark, "summary")
    write_summary(rows, USER_SPU_SUMMARY, path)
    return read_summary(spark, path).drop("ts")


def order_metric_rows(spark, sf):
    rows = cdc.order_metric_rows(inputs.order_detail(spark, sf), ("id", "province_id"))
    return with_event_time(rows, "create_time").select(
        "id", "province_id", "order_id", "order_amount", F.unix_millis("event_time").alias("ts"))


def json_scalars(spark, sf):
    events = inputs.table(spark, sf, "events")
    data = F.create_map(F.lit("kind"), F.col("event_type"), F.lit("user"), inputs.text("user_id"))
    shape = "struct<k:string>"
    k = scalars.json_path(F.from_json("props", shape), "k")
    a = F.array("event_type", F.lit("view"))
    b = F.array(F.lit("click"), F.lit("view"))
    return events.select(
        "event_id",
        scalars.number_of(k, "bigint").alias("k"),
        scalars.number_of(F.col("event_type"), "double").alias("not_a_number"),
        scalars.map_get(data, "kind").alias("kind"), scalars.map_get(data, "none").alias("absent"),
        scalars.csv_contains(F.lit("view,click"), F.col("event_type")).cast("bigint").alias("listed"),
        scalars.set_size(scalars.set_union(a, b)).cast("bigint").alias("members"),
        scalars.upper_name("event_type").alias("upper_name"))


def topic_roundtrip(spark, sf):
    """Details written to a JSON topic and read back with the same columns."""
    root = work_dir(spark, "topic")
    details = inputs.order_detail(spark, sf).drop(*TIE)
    write_json_topic(details, "details", fmt="text", root=root)
    return read_json_stream(spark, "details", details.schema, fmt="text", root=root, streaming=False)


def changelog_roundtrip(spark, sf):
    """Change-log text read with its maps."""
    root = work_dir(spark, "topic")
    changes = inputs.trade_changelog(spark, sf).drop("seq")
    write_json_topic(changes, "topic_db", fmt="text", root=root)
    rows = read_changelog(spark, fmt="text", root=root, streaming=False)
    return rows.select("table", "type", scalars.map_get("data", "id").alias("id"),
                       scalars.map_get("data", "order_id").alias("order_id"),
                       scalars.map_get("data", "create_time").alias("create_time"),
                       scalars.map_get("old", "id").alias("old_id"))


def visit_metric_rows(spark, sf):
    pages = inputs.page_log(spark, sf)
    return ops.union_metrics(ops.visit_metrics(pages, "page"),
                             ops.visit_metrics(ops.session_starts(pages), "bounce"))


def daily_login_flags(spark, sf):
    rows = traffic.login_flags(inputs.page_log(spark, sf), ("arrival",), 3)
    return rows.select("uid", "day", "ts", "arrival", "back_ct", "uu_ct")


def daily_payer_flags(spark, sf):
    rows = trade.payer_flags(inputs.pay_detail(spark, sf), TIE)
    return rows.select("user_id", "day", "callback_time", "unique_user_ct", "new_user_ct")


def window_sums(spark, sf):
    rows = with_event_time(inputs.order_detail(spark, sf), "create_time")
    rows = rows.withColumn("qty", scalars.number_of("sku_num", "bigint"))
    return with_bounds(window_sum_by(rows, ("province_id",), ("qty",), size=MONTH), stamp=False)


def distinct_orders(spark, sf):
    rows = with_event_time(inputs.order_detail(spark, sf), "create_time")
    rows = rows.withColumn("order_amount", scalars.number_of("split_total_amount"))
    return with_bounds(window_distinct_sum(rows, ("province_id",), size=MONTH), stamp=False)


QUERIES = {
    "parse_and_split_dirty": parse_and_split_dirty,
    "page_view_log": page_view_log,
    "page_view_typed": page_view_typed,
    "session_starts": session_starts,
    "filter_pages": filter_pages,
    "login_events": login_events,
    "visit_metric_rows": visit_metric_rows,
    "unique_visitor_daily": unique_visitor_daily,
    "bounces_10s": bounces_10s,
    "bounces_1h": bounces_1h,
    "visit_summary_10s": visit_summary,
    "visit_summary_1d": visit_summary_1d,
    "home_detail_uv_10s": home_detail_uv,
    "home_detail_uv_1d": home_detail_uv_1d,
    "login_returning_10s": login_returning,
    "login_returning_gap3_10s": login_returning_gap3,
    "daily_login_flags": daily_login_flags,
    "cdc_order_detail": _view("order_detail", ORDER_DETAIL_CDC),
    "cdc_order_info": _view("order_info", ORDER_INFO_CDC),
    "cdc_order_activity": _view("order_detail_activity", ORDER_ACTIVITY_CDC),
    "cdc_order_coupon": _view("order_detail_coupon", ORDER_COUPON_CDC),
    "payment_success_view": payment_success_view,
    "order_detail_wide": wide_details,
    "order_detail_upsert": order_detail_upsert,
    "pay_detail_success": pay_detail_success,
    "latest_per_detail": latest_per_detail,
    "first_per_detail": first_per_detail,
    "left_join_upsert": left_join_upsert,
    "order_metric_rows": order_metric_rows,
    "window_sums": window_sums,
    "distinct_orders": distinct_orders,
    "province_orders_10s": province_orders,
    "province_orders_30d": province_orders_30d,
    "province_orders_drop_30d": province_orders_drop,
    "user_spu_orders_10s": user_spu_orders,
    "user_spu_orders_30d": user_spu_orders_30d,
    "daily_payer_flags": daily_payer_flags,
    "paying_users_10s": paying_users,
    "paying_users_1d": paying_users_1d,
    "config_routing": config_routing,
    "dimension_snapshot": dimension_snapshot,
    "dimension_compacted": dimension_compacted,
    "nation_region_lookup": nation_region_lookup,
    "nation_region_lookup_drop": nation_region_lookup_drop,
    "compare_row_time": compare_row_time,
    "time_text": time_text,
    "summary_sink_columns": summary_sink_columns,
    "json_scalars": json_scalars,
    "topic_roundtrip": topic_roundtrip,
    "changelog_roundtrip": changelog_roundtrip,
}
