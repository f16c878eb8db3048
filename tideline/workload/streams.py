"""Streaming twins of the registered queries: the same rows replayed as a stream.

Inputs derived by Spark are written to the work folder and read back as file streams.
Large ones arrive in the order of their event time, a slice at a time, so that state holds
what the watermark asks for and not the whole input. A closing row, later than all others and matching nothing, moves the watermark past
them; it never shows in a result. Each query ends when its input is used up.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import DATE_TIME, row_time
from tideline.operators import dedup
from tideline.operators.bounce import bounces
from tideline.operators.lookup import lookup_chain
from tideline.operators.windows import window_sum_by, with_bounds, with_event_time
from tideline.plans import jobs, traffic, trade
from tideline.plans.left_join import left_join_upsert
from tideline.schemas import (
    ORDER_DETAIL_COLUMNS, PAY_DETAIL_COLUMNS, PAYMENT_SUCCESS, TABLE_PROCESS_TOPIC, TOPIC_DB, dimension_schema)
from tideline.session import IN_MEMORY, REMOVE_SHUFFLES, setting, stream_session, work_dir
from tideline.sinks.dimension import read_dimension
from tideline.sinks.files import age_parts, make_folder, move_folder, publish_parts
from tideline.sinks.topics import write_json_topic
from tideline.sinks.upsert import read_upsert
from tideline.streaming.run import run_with_restarts, start_query
from tideline.workload import batch, inputs
from tideline.workload.inputs import TIE

END = "__end__"
LATER_MS = 90 * 86_400_000
ONCE = {"availableNow": True}


# Lines of orders that arrive at once, and the files they come in. Joins bounded in time hold
# about two slices, in memory.
SLICE_LINES = 4_000_000
JOIN_LINES = 1_000_000
SLICE_FILES = 8


def slices_of(spark, sf, lines=None):
    """The number of slices that the rows derived from the lines of orders arrive in."""
    return max(1, -(-inputs.table(spark, sf, "lineitem").count() // (lines or SLICE_LINES)))


def in_slices(slices):
    """Deals rows out by ranges of a time column, for ``replay``; None for a single slice."""
    if slices > 1:
        return lambda rows, time: rows.repartitionByRange(slices * SLICE_FILES, time)


def replay(session, df, folder, closing=None, time=None, slices=1):
    """Write ``df``, and the closing row, and read them as a stream.

    With several ``slices`` the rows are dealt by ranges of their event ``time``, or were dealt
    by ``in_slices`` before if there is none. A file stream reads by age, so the files get
    ages in the order of their ranges, and one query takes a slice in each micro-batch. Where
    the file system does not keep ages, the first slice is there at once and ``to_table``
    lets the others follow.
    """
    rows = df if closing is None else df.unionByName(closing)
    stream = session.readStream.schema(rows.schema)
    if slices == 1:
        rows.write.parquet(folder, compression="zstd")
        return stream.parquet(folder)
    if time is not None:
        rows = rows.repartitionByRange(slices * SLICE_FILES, time)
    # Shuffle files go with the query that made them, here and in each micro-batch.
    session.conf.set(REMOVE_SHUFFLES, "true")
    with setting(rows.sparkSession, REMOVE_SHUFFLES, "true"):
        rows.write.parquet(f"{folder}-waiting", compression="zstd")
    if age_parts(session, f"{folder}-waiting"):
        move_folder(session, f"{folder}-waiting", folder)
    else:
        make_folder(session, folder)
        publish_parts(session, f"{folder}-waiting", folder, SLICE_FILES)
    return stream.option("maxFilesPerTrigger", SLICE_FILES).parquet(folder)


def to_table(spark, df, folder, trigger=None, feeds=()):
    """Run a streaming query to the end of its input and read what it wrote.

    It goes on from its checkpoint each time the next slices of its ``feeds`` have arrived.
    """
    arrived = True
    while arrived:
        run_with_restarts(lambda: start_query(
            df, f"{folder}/checkpoint", fmt="parquet", path=f"{folder}/out", trigger=trigger or ONCE))
        arrived = any([publish_parts(spark, f"{feed}-waiting", feed, SLICE_FILES) for feed in feeds])
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def _shaped(row, schema):
    """A one-row frame in the column order and types of ``schema``; other columns are null."""
    return row.select(*(
        (F.col(f.name) if f.name in row.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields))


def page_stream(spark, session, sf, folder, closings=1):
    """Page views and closing rows, each of another device and 90 days after the one before."""
    pages = inputs.page_log(spark, sf)
    closing = None
    for k in range(closings):
        row = _closing_page(pages, END * (k + 1), (k + 1) * LATER_MS)
        closing = row if closing is None else closing.unionByName(row)
    return replay(session, pages, folder, closing)


def _closing_page(pages, name, later):
    common = F.struct(*(F.lit(name).alias(n) for n in ("mid", "uid", "vc", "ch", "ar")))
    page = F.struct(F.lit("home").alias("page_id"), F.lit(None).cast("string").alias("last_page_id"),
                    F.lit(0).cast("bigint").alias("during_time"))
    last = pages.agg((F.max("ts") + later).alias("ts"), F.max("arrival").alias("arrival"))
    return last.select(common.alias("common"), page.alias("page"), "ts", "arrival")


def _later(df, time):
    """Date-time text ``_t`` well after the last ``time``."""
    return df.agg((F.max(time) + F.expr("INTERVAL 90 DAYS")).alias("_t")).select(
        F.date_format("_t", DATE_TIME).alias("_t"))


def _closing_time(df, column):
    """Date-time text well after the last in ``column``."""
    return _later(df, F.to_timestamp(column, DATE_TIME)).select(F.col("_t").alias(column))


def detail_stream(spark, session, sf, folder, lines=None):
    slices = slices_of(spark, sf, lines)
    details = inputs.order_detail(spark, sf, in_slices(slices))
    # No line is later than the last order; reading the lines only for that costs their join once more.
    last = _later(inputs.order_times(spark, sf), "created").select(F.col("_t").alias("create_time"))
    closing = _shaped(last.withColumn("id", F.lit(END)), details.schema)
    return replay(session, details, folder, closing, slices=slices)


def change_stream(spark, session, sf, folder, tables):
    """The trade change log, closed by one row per table."""
    slices = slices_of(spark, sf, JOIN_LINES)
    changes = inputs.trade_changelog(spark, sf, in_slices(slices))
    later = _later(inputs.order_times(spark, sf), "created")
    closing = None
    for name, kind in tables:
        keys = ("id", "order_id", "order_detail_id", "source_type", "payment_type")
        data = F.create_map(*(x for k in keys for x in (F.lit(k), F.lit(f"{END}{name}"))),
                            F.lit("create_time"), F.col("_t"), F.lit("callback_time"), F.col("_t"),
                            F.lit("payment_status"), F.lit(PAYMENT_SUCCESS))
        row = _shaped(later.select(F.lit("shop").alias("database"), F.lit(name).alias("table"),
                                   F.lit(kind).alias("type"), data.alias("data")), changes.schema)
        closing = row if closing is None else closing.unionByName(row)
    return replay(session, changes, folder, closing, slices=slices)


ORDER_TABLES = tuple((name, "insert") for name in (
    "order_detail", "order_info", "order_detail_activity", "order_detail_coupon"))


# --- traffic --------------------------------------------------------------------------

def stream_unique_visitor_daily(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    pages = page_stream(spark, session, sf, f"{folder}/in")
    rows = traffic.unique_visitors(pages, ("arrival",)).where(F.col("common.mid") != END)
    return batch._flat(to_table(spark, rows, folder))


def stream_bounces_1h(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    pages = page_stream(spark, session, sf, f"{folder}/in")
    rows = bounces(pages, arrival="arrival", within_ms=batch.HOUR_MS)
    return batch._flat(to_table(spark, rows, folder))


def stream_visit_summary_1d(spark, sf):
    """Three queries chained by written topics, as the jobs are.

    The slowest input governs, so the bounces need a closing row too: the second closing
    page lets the bounce of the first through.
    """
    session, folder = stream_session(spark), work_dir(spark, "stream")

    def pages():
        return session.readStream.schema(source.schema).parquet(f"{folder}/in")

    source = page_stream(spark, session, sf, f"{folder}/in", closings=2)
    visitors = to_table(spark, traffic.unique_visitors(pages(), ("arrival",)), f"{folder}/visitors")
    jumps = to_table(spark, bounces(pages(), arrival="arrival"), f"{folder}/jumps")
    read = session.readStream.schema(source.schema)
    rows = traffic.visit_summary(read.parquet(f"{folder}/visitors/out"), read.parquet(f"{folder}/jumps/out"),
                                 pages(), batch.DAY, stamp=False)
    return to_table(spark, rows, f"{folder}/summary")


def stream_home_detail_uv_10s(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    pages = page_stream(spark, session, sf, f"{folder}/in")
    return to_table(spark, traffic.home_detail_summary(pages, ("arrival",), stamp=False), folder)


def stream_login_returning_gap3_10s(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    pages = page_stream(spark, session, sf, f"{folder}/in")
    return to_table(spark, traffic.login_summary(pages, ("arrival",), 3, stamp=False), folder)


# --- trade ----------------------------------------------------------------------------

def stream_order_detail_wide(spark, sf):
    session, folder = stream_session(spark, state=IN_MEMORY), work_dir(spark, "stream")
    changes = change_stream(spark, session, sf, f"{folder}/in", ORDER_TABLES)
    joined = to_table(spark, trade.joined_changes(changes, database="shop").drop("event_time"), folder,
                      feeds=[f"{folder}/in"])
    return trade.name_source_type(joined, inputs.base_dic(spark, sf))


def stream_pay_detail_success(spark, sf):
    session, folder = stream_session(spark, state=IN_MEMORY), work_dir(spark, "stream")
    changes = change_stream(spark, session, sf, f"{folder}/in", (("payment_info", "update"),))
    details = detail_stream(spark, session, sf, f"{folder}/details", JOIN_LINES).drop(*TIE)
    joined = trade.joined_payments(changes, details).drop("event_time", "od_event_time")
    paid = to_table(spark, joined, folder, feeds=[f"{folder}/in", f"{folder}/details"])
    named = trade.name_payment_type(paid, inputs.base_dic(spark, sf))
    return named.select(*PAY_DETAIL_COLUMNS, "row_op_ts")


def stream_latest_per_detail(spark, sf):
    """Latest version per detail within its window."""
    session, folder = stream_session(spark), work_dir(spark, "stream")
    details = detail_stream(spark, session, sf, f"{folder}/in")
    timed = with_event_time(details.withColumn("version", row_time("row_op_ts")), "create_time")
    last = dedup.latest_per_key_windowed(timed, ("id",), ("version", *TIE)).drop("event_time")
    return to_table(spark, last, folder, feeds=[f"{folder}/in"]).select(*ORDER_DETAIL_COLUMNS, "row_op_ts")


def stream_first_per_detail(spark, sf):
    """First version per detail, let through by keyed state that silence clears.

    State that ends by wall clock asks for one more batch for ever, so this runs as a
    single batch; the state partitions grow with it.
    """
    session, folder = stream_session(spark), work_dir(spark, "stream")
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), slices_of(spark, sf) * SLICE_FILES)
    session.conf.set("spark.sql.shuffle.partitions", str(parts))
    details = replay(session, inputs.order_detail(spark, sf), f"{folder}/in")
    first = dedup.first_per_key_ttl(details.withColumn("version", row_time("row_op_ts")), ("id",),
                                    ("version", *TIE))
    return to_table(spark, first, folder, {"once": True}).select(*ORDER_DETAIL_COLUMNS, "row_op_ts")


def stream_province_orders_30d(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    details = detail_stream(spark, session, sf, f"{folder}/in")
    totals = to_table(spark, with_bounds(trade.province_totals(details, TIE, batch.MONTH), stamp=False), folder,
                      feeds=[f"{folder}/in"])
    return trade.name_provinces(totals, inputs.provinces(spark, sf))


def stream_user_spu_orders_30d(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    details = detail_stream(spark, session, sf, f"{folder}/in")
    dims = inputs.spu_dims(spark, sf)
    rows = trade.user_spu_rows(details, dims["sku_info"].where(F.col("id").isNotNull()), ("row_op_ts", *TIE))
    totals = to_table(spark, with_bounds(trade.user_spu_totals(rows, batch.MONTH), stamp=False), folder,
                      feeds=[f"{folder}/in"])
    return trade.name_user_spu(totals, dims)


def stream_paying_users_10s(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    paid = inputs.pay_detail(spark, sf)
    closing = _shaped(_closing_time(paid, "callback_time").withColumn("order_detail_id", F.lit(END))
                      .withColumn("user_id", F.lit(END)), paid.schema)
    payments = replay(session, paid, f"{folder}/in", closing)
    return to_table(spark, trade.payer_summary(payments, TIE, stamp=False), folder)


def stream_window_sums(spark, sf):
    session, folder = stream_session(spark), work_dir(spark, "stream")
    details = detail_stream(spark, session, sf, f"{folder}/in")
    rows = with_event_time(details, "create_time").withColumn("qty", F.col("sku_num").cast("bigint"))
    sums = with_bounds(window_sum_by(rows, ("province_id",), ("qty",), size=batch.MONTH), stamp=False)
    return to_table(spark, sums, folder, feeds=[f"{folder}/in"])


# --- upserts --------------------------------------------------------------------------

def stream_left_join_upsert(spark, sf):
    """Both sides logged as upsert tables per micro-batch, joined for the keys that changed."""
    session, folder = stream_session(spark), work_dir(spark, "stream")
    a, b = (replay(session, side, f"{folder}/{name}_in")
            for side, name in zip(batch.join_sides(spark, sf), ("a", "b")))
    run_with_restarts(lambda: left_join_upsert(a, b, folder, f"{folder}/checkpoint", ONCE))
    return read_upsert(spark, f"{folder}/joined", ("id_a",))


def stream_dimension_snapshot(spark, sf):
    """The dimension job on topics: all changes of a key in one micro-batch, the last one wins."""
    session, folder = stream_session(spark), work_dir(spark, "stream")
    w = jobs.Warehouse(session, folder, f"{folder}/checkpoints", trigger=ONCE).prepare()
    write_json_topic(inputs.dimension_changelog(spark, sf).drop("seq"), TOPIC_DB, fmt="text", root=w.topics)
    write_json_topic(inputs.config_envelopes(spark), TABLE_PROCESS_TOPIC, fmt="text", root=w.topics)
    run_with_restarts(lambda: jobs.dim_job(w))
    out = None
    for _, sink, columns, pk, extend in inputs.ROUTES:
        shape = dimension_schema(columns, pk, extend)
        rows = read_dimension(session, f"{w.root}/dims", sink, shape).select(
            F.lit(sink).alias("sink_table"), "id", *(
                (F.col(c) if c in shape.names else F.lit(None).cast("string")).alias(c)
                for c in ("name", "sku_name", "tm_id", "spu_id")))
        out = rows if out is None else out.unionByName(rows)
    return out


def stream_nation_region_lookup(spark, sf):
    """Suppliers as a stream, looked up in static dimensions."""
    session, folder = stream_session(spark), work_dir(spark, "stream")
    suppliers = replay(session, inputs.table(spark, sf, "supplier").select(
        "s_suppkey", inputs.text("s_nationkey").alias("category2_id")), f"{folder}/in")
    dims = inputs.spu_dims(spark, sf)
    rows = lookup_chain(suppliers, [
        (dims["base_category2"], "category2_id", {"nation": "name", "category1_id": "category1_id"}),
        (dims["base_category1"], "category1_id", {"region": "name"}),
    ])
    return to_table(spark, rows, folder)


# Streaming query -> the batch query whose SQL it is checked against.
TWINS = {
    "stream_unique_visitor_daily": (stream_unique_visitor_daily, "unique_visitor_daily"),
    "stream_bounces_1h": (stream_bounces_1h, "bounces_1h"),
    "stream_visit_summary_1d": (stream_visit_summary_1d, "visit_summary_1d"),
    "stream_home_detail_uv_10s": (stream_home_detail_uv_10s, "home_detail_uv_10s"),
    "stream_login_returning_gap3_10s": (stream_login_returning_gap3_10s, "login_returning_gap3_10s"),
    "stream_order_detail_wide": (stream_order_detail_wide, "order_detail_wide"),
    "stream_pay_detail_success": (stream_pay_detail_success, "pay_detail_success"),
    "stream_latest_per_detail": (stream_latest_per_detail, "latest_per_detail"),
    "stream_first_per_detail": (stream_first_per_detail, "first_per_detail"),
    "stream_province_orders_30d": (stream_province_orders_30d, "province_orders_30d"),
    "stream_user_spu_orders_30d": (stream_user_spu_orders_30d, "user_spu_orders_30d"),
    "stream_paying_users_10s": (stream_paying_users_10s, "paying_users_10s"),
    "stream_window_sums": (stream_window_sums, "window_sums"),
    "stream_left_join_upsert": (stream_left_join_upsert, "left_join_upsert"),
    "stream_dimension_snapshot": (stream_dimension_snapshot, "dimension_snapshot"),
    "stream_nation_region_lookup": (stream_nation_region_lookup, "nation_region_lookup"),
}
