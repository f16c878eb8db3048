"""Page logs, change logs, details and dimensions derived from the driver tables.

Every function is a plan over the whole of its tables; the same rules are stated in
SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.time import DATE_TIME
from tideline.schemas import ORDER_DETAIL_COLUMNS, PAYMENT_SUCCESS, text_struct



def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def money(c):
    return F.col(c).cast("decimal(15,2)").cast("string")


def _page_columns():
    kind = F.col("event_type")
    key = F.col("user_id")
    common = F.struct(
        text(key).alias("mid"),
        F.when(kind != "error", text(key)).alias("uid"),
        F.concat(F.lit("v"), text(key % 3)).alias("vc"),
        F.concat(F.lit("c"), text(key % 2)).alias("ch"),
        F.concat(F.lit("a"), text(key % 5)).alias("ar"),
    )
    page = F.struct(
        F.when(kind == "view", "home").when(kind == "click", "good_detail").otherwise(kind).alias("page_id"),
        F.when(kind.isin("view", "error"), F.lit(None)).when(kind == "signup", "login")
        .otherwise("home").alias("last_page_id"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
    )
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return common, page, ms


def page_log(spark, sf_dir):
    """Typed page views with an ``arrival`` number."""
    common, page, ms = _page_columns()
    return table(spark, sf_dir, "events").select(
        common.alias("common"), page.alias("page"), ms.alias("ts"), F.col("event_id").alias("arrival"))


def raw_log(spark, sf_dir):
    """Log text with error rows, undeclared keys, exposure lists, bad and empty records."""
    common, page, ms = _page_columns()
    kind = F.col("event_type")
    odd = F.col("event_id") % 4 == 1
    record = F.to_json(F.struct(
        common.alias("common"), page.alias("page"), ms.alias("ts"),
        F.when(kind == "error", F.struct(F.lit(500).alias("code"))).alias("err"),
        F.when(odd, F.array(F.struct(F.lit("banner").alias("item")))).alias("displays"),
        F.when(odd, F.array(F.struct(F.lit("tap").alias("action_id")))).alias("actions"),
        F.col("event_id").alias("offset"),
    ))
    value = (F.when(F.col("event_id") % 17 == 0, F.concat(F.lit("oops-"), text("event_id")))
             .when(F.col("event_id") % 23 == 0, F.lit("")).otherwise(record))
    return table(spark, sf_dir, "events").select(value.alias("value"))


def _seconds_after(time, seconds):
    return time.cast("timestamp") + F.make_dt_interval(secs=seconds)


def _when(time):
    return F.date_format(time, DATE_TIME)


def order_times(spark, sf_dir):
    """Orders with creation time and province."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.withColumn("created", _seconds_after(F.col("o_orderdate"), F.col("o_orderkey") % 20))


def _detail_id():
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def order_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    joined = lines.join(order_times(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.withColumn("detail_id", _detail_id())


# What detail rows and changes are made of.
LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                "l_shipdate")
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "c_nationkey")


def order_detail(spark, sf_dir, arrange=None):
    """The detail table; ``id`` comes several times, ordered by ``row_op_ts`` and part/supplier.

    ``arrange`` deals the rows out by a time column; it gets them before they are texts.
    """
    null = F.lit(None).cast("string")
    values = {
        "id": _detail_id(), "order_id": text("l_orderkey"), "user_id": text("o_custkey"),
        "sku_id": text("l_partkey"), "sku_name": F.concat(F.lit("sku-"), text("l_partkey")),
        "sku_num": text(F.col("l_quantity").cast("bigint")), "order_price": money("l_extendedprice"),
        "province_id": text("c_nationkey"), "activity_id": null, "activity_rule_id": null,
        "coupon_id": null, "create_time": _when("created"), "source_id": null,
        "source_type_id": text(F.col("l_orderkey") % 6), "source_type_name": null,
        "split_activity_amount": null, "split_coupon_amount": null,
        "split_total_amount": money("l_extendedprice"),
    }
    lines = order_lines(spark, sf_dir).select(*LINE_COLUMNS, "o_custkey", "c_nationkey", "created")
    if arrange:
        lines = arrange(lines, "created")
    return lines.select(
        *(values[c].alias(c) for c in ORDER_DETAIL_COLUMNS),
        F.concat(_when("l_shipdate"), F.lit("Z")).alias("row_op_ts"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))


TIE = ("part", "supp")


def sequence(ts, xid=None, xoffset=None):
    """The order of a change, as the reader of the change log makes it."""
    given = (F.lit(None) if c is None else c for c in (ts, xid, xoffset))
    return F.array(*(c.cast("bigint") for c in given), *[F.lit(None).cast("bigint")] * 2)


def _change_sources(spark, sf_dir):
    """The lines and orders behind the changes: ``table``, the time ``at`` of the change, numbers and dates."""
    orders, lines = order_times(spark, sf_dir), order_lines(spark, sf_dir)
    extra = F.col("l_linenumber") + F.col("l_suppkey") % 8
    sources = (
        ("order_detail", lines, LINE_COLUMNS, F.col("l_linenumber")),
        ("order_info", orders, ORDER_COLUMNS, None),
        ("order_detail_activity", lines.where(F.col("l_linenumber") % 3 == 0), LINE_COLUMNS, extra),
        ("order_detail_coupon", lines.where(F.col("l_returnflag") == "R"), LINE_COLUMNS, extra),
        ("payment_info", orders, ORDER_COLUMNS, F.col("o_orderkey") % 1800),
    )
    out = None
    for name, rows, columns, seconds in sources:
        at = F.col("created") if seconds is None else _seconds_after(F.col("created"), seconds)
        rows = rows.select(F.lit(name).alias("table"), at.alias("at"), *columns)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def trade_changelog(spark, sf_dir, arrange=None):
    """Change-log rows of orders, details, activities, coupons and payments.

    ``arrange`` deals them out by a time column; it gets them before they are maps of text.
    """
    insert, update = F.lit("insert"), F.lit("update")
    version = F.unix_millis(F.col("l_shipdate").cast("timestamp")), F.col("l_partkey"), F.col("l_suppkey")
    order_version = F.lit(0), F.col("o_orderkey"), F.lit(0)
    extra_id = F.concat_ws("-", _detail_id(), "l_partkey", "l_suppkey")
    changes = {
        "order_detail": (insert, version, {
            "id": _detail_id(), "order_id": text("l_orderkey"), "sku_id": text("l_partkey"),
            "sku_name": F.concat(F.lit("sku-"), text("l_partkey")), "order_price": money("l_extendedprice"),
            "sku_num": text(F.col("l_quantity").cast("bigint")), "create_time": _when("at"),
            "source_type": text(F.col("l_orderkey") % 6), "source_id": text("l_suppkey"),
            "split_total_amount": money("l_extendedprice"), "noise": F.lit("x"),
        }),
        "order_info": (insert, order_version, {
            "id": text("o_orderkey"), "user_id": text("o_custkey"), "province_id": text("c_nationkey"),
            "order_status": F.col("o_orderstatus"), "total_amount": money("o_totalprice"),
            "create_time": _when("at"),
        }),
        "order_detail_activity": (insert, version, {
            "id": extra_id, "order_id": text("l_orderkey"),
            "order_detail_id": _detail_id(), "activity_id": text("l_suppkey"),
            "activity_rule_id": text(F.col("l_suppkey") % 10), "sku_id": text("l_partkey"),
            "create_time": _when("at"),
        }),
        "order_detail_coupon": (insert, version, {
            "id": extra_id, "order_id": text("l_orderkey"),
            "order_detail_id": _detail_id(), "coupon_id": text("l_partkey"),
            "coupon_use_id": text(F.col("l_partkey") % 10), "sku_id": text("l_partkey"),
            "create_time": _when("at"),
        }),
        "payment_info": (update, order_version, {
            "id": text("o_orderkey"), "user_id": text("o_custkey"), "order_id": text("o_orderkey"),
            "payment_type": text(F.col("o_orderkey") % 7), "callback_time": _when("at"),
            "payment_status": F.when(F.col("o_orderstatus") == "F", PAYMENT_SUCCESS).otherwise("1601"),
        }),
    }

    def by_table(value):
        chosen = F
        for name, (kind, order, data) in changes.items():
            chosen = chosen.when(F.col("table") == name, value(kind, order, data))
        return chosen

    rows = _change_sources(spark, sf_dir)
    if arrange:
        rows = arrange(rows, "at")
    return rows.select(
        F.lit("shop").alias("database"), "table", by_table(lambda kind, order, data: kind).alias("type"),
        by_table(lambda kind, order, data: F.create_map(
            *(part for key, value in data.items() for part in (F.lit(key), value)))).alias("data"),
        by_table(lambda kind, order, data: F.create_map(F.lit("id"), data["id"])).alias("old"),
        by_table(lambda kind, order, data: sequence(*order)).alias("seq"))


def base_dic(spark, sf_dir):
    """The dictionary: one entry per order priority, coded by its first character."""
    found = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return found.select(F.substring("o_orderpriority", 1, 1).alias("dic_code"),
                        F.col("o_orderpriority").alias("dic_name"))


def pay_detail(spark, sf_dir):
    """Paid details: lines of ``F`` orders with callback time, versioned by ``row_op_ts``."""
    lines = order_lines(spark, sf_dir).where(F.col("o_orderstatus") == "F")
    return lines.select(
        F.col("detail_id").alias("order_detail_id"), text("l_orderkey").alias("order_id"),
        text("o_custkey").alias("user_id"),
        _when(_seconds_after(F.col("created"), F.col("o_orderkey") % 1800)).alias("callback_time"),
        F.concat(_when("l_shipdate"), F.lit("Z")).alias("row_op_ts"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))


def provinces(spark, sf_dir):
    """Nations, some missing."""
    return (table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 7 != 3)
            .select(text("n_nationkey").alias("id"), F.col("n_name").alias("name")))


def spu_dims(spark, sf_dir):
    """Dimensions of the user and product summary, each with some keys missing."""
    part = table(spark, sf_dir, "part")
    return {
        "sku_info": part.where(F.col("p_partkey") % 11 != 4).select(
            text("p_partkey").alias("id"), text("p_size").alias("spu_id"), F.col("p_brand").alias("tm_id"),
            text(F.col("p_partkey") % 100).alias("category3_id")),
        "spu_info": part.where(F.col("p_size") != 13).select("p_size").distinct().select(
            text("p_size").alias("id"), F.concat(F.lit("spu-"), text("p_size")).alias("spu_name")),
        "base_trademark": part.where(F.col("p_brand") != "Brand#7").select("p_brand").distinct().select(
            F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name")),
        "base_category3": table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 10 != 3).select(
            text("s_suppkey").alias("id"), F.col("s_name").alias("name"),
            text("s_nationkey").alias("category2_id")),
        "base_category2": table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 7 != 3).select(
            text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            text("n_regionkey").alias("category1_id")),
        "base_category1": table(spark, sf_dir, "region").where(F.col("r_regionkey") != 4).select(
            text("r_regionkey").alias("id"), F.col("r_name").alias("name")),
    }


def dimension_changelog(spark, sf_dir):
    """Change-log rows of parts, suppliers and nations: inserts, updates and deletes.

    All are of one second; the transaction orders them. Updates of parts carry only some
    columns, so rows are merged column by column; the last text is not the largest, and
    may be empty.
    """
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")

    def rows(df, name, kind, step, data):
        pairs = [p for k, v in data.items() for p in (F.lit(k), v)]
        return df.select(F.lit("shop").alias("database"), F.lit(name).alias("table"),
                         F.lit(kind).alias("type"), F.create_map(*pairs).alias("data"),
                         F.lit(1).cast("bigint").alias("ts"), F.lit(step).cast("bigint").alias("xid"),
                         sequence(F.lit(1), F.lit(step)).alias("seq"))

    sku = {"id": text("p_partkey"), "sku_name": F.col("p_name"), "tm_id": F.col("p_brand"),
           "spu_id": text("p_size"), "price": money("p_retailprice")}
    frames = [
        rows(part, "sku_info", "insert", 0, sku),
        rows(part.where(F.col("p_partkey") % 3 == 0), "sku_info", "update", 1,
             {"id": text("p_partkey"), "sku_name": F.upper("p_name")}),
        rows(part.where(F.col("p_partkey") % 5 == 0), "sku_info", "update", 2,
             {"id": text("p_partkey"), "tm_id": F.lit("")}),
        rows(part.where(F.col("p_partkey") % 7 == 0), "sku_info", "delete", 3, sku),
        rows(supplier, "base_supplier", "bootstrap-insert", 0,
             {"id": text("s_suppkey"), "name": F.col("s_name"), "nation": text("s_nationkey")}),
        rows(supplier.where(F.col("s_suppkey") % 2 == 0), "base_supplier", "update", 1,
             {"id": text("s_suppkey"), "name": F.concat(F.col("s_name"), F.lit("'s"))}),
        rows(nation, "base_nation", "insert", 0, {"id": text("n_nationkey"), "name": F.col("n_name")}),
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# The routing rows of the dimension queries (nations are not routed).
ROUTES = (
    ("sku_info", "dim_sku_info", "id,sku_name,tm_id,spu_id", "id", None),
    ("base_supplier", "dim_supplier", "id,name", None, "SALT_BUCKETS = 3"),
)


def config_envelopes(spark):
    """Change envelopes of the routing table, with one route added and deleted again."""
    names = text_struct("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")
    dropped = ("base_nation", "dim_nation", "id,name", None, None)
    rows = [(None, r, "r", 1, 0) for r in ROUTES]
    rows += [(None, dropped, "c", 2, 0), (dropped, None, "d", 3, 0)]
    schema = (text_struct().add("before", names).add("after", names).add("op", "string")
              .add("ts_ms", "long").add("seq", "long"))
    return spark.createDataFrame(rows, schema)
