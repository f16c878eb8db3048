"""Names and shapes of topics, change-log tables, dimensions and summaries."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: topic names, one spelling for writer and reader ------------------
TOPIC_LOG = "topic_log"
TOPIC_DB = "topic_db"
TABLE_PROCESS_TOPIC = "table_process"
TOPIC_PAGE_VIEW = "dwd_traffic_page_view"
TOPIC_UNIQUE_VISITOR = "dwd_traffic_unique_visitor_detail"
TOPIC_USER_JUMP = "dwd_traffic_user_jump"
TOPIC_ORDER_DETAIL = "dwd_trade_order_detail"
TOPIC_PAY_DETAIL = "dwd_trade_pay_detail_suc"

# --- fixed values: change types kept for dimensions, and the payment success code ---
CHANGE_TYPES = ("insert", "update", "bootstrap-insert")
PAYMENT_SUCCESS = "1602"

# --- fixed values: column lists of the change-log views ----------------------------
ORDER_DETAIL_CDC = (
    "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
    "source_type", "source_id", "split_total_amount", "split_activity_amount",
    "split_coupon_amount",
)
ORDER_INFO_CDC = (
    "id", "consignee", "consignee_tel", "total_amount", "order_status", "user_id",
    "payment_way", "delivery_address", "order_comment", "out_trade_no", "trade_body",
    "create_time", "operate_time", "expire_time", "process_status", "tracking_no",
    "parent_order_id", "province_id", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "feight_fee_reduce", "refundable_time",
)
ORDER_ACTIVITY_CDC = (
    "id", "order_id", "order_detail_id", "activity_id", "activity_rule_id", "sku_id",
    "create_time",
)
ORDER_COUPON_CDC = (
    "id", "order_id", "order_detail_id", "coupon_id", "coupon_use_id", "sku_id",
    "create_time",
)
PAYMENT_CDC = ("user_id", "order_id", "payment_type", "callback_time")

# --- fixed values: column order of the two detail tables ---------------------------
ORDER_DETAIL_COLUMNS = (
    "id", "order_id", "user_id", "sku_id", "sku_name", "sku_num", "order_price",
    "province_id", "activity_id", "activity_rule_id", "coupon_id", "create_time",
    "source_id", "source_type_id", "source_type_name", "split_activity_amount",
    "split_coupon_amount", "split_total_amount",
)
PAY_DETAIL_COLUMNS = (
    "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
    "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
    "payment_type_name", "callback_time", "source_id", "source_type_id",
    "source_type_name", "sku_num", "order_price", "split_activity_amount",
    "split_coupon_amount", "split_payment_amount",
)

ROW_TIME = "row_op_ts"


def text_struct(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Leaves are text: numbers that arrive quoted still read, `number_of` casts them.
PAGE_LOG_TEXT = T.StructType([
    T.StructField("common", text_struct("mid", "uid", "vc", "ch", "ar")),
    T.StructField("page", text_struct("page_id", "last_page_id", "during_time")),
    T.StructField("ts", T.StringType()),
    T.StructField("err", T.StringType()),
    T.StructField("start", T.StringType()),
])

CHANGELOG = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("data", T.MapType(T.StringType(), T.StringType())),
    T.StructField("old", T.MapType(T.StringType(), T.StringType())),
    # When and in which transaction the change was made, and its place there.
    T.StructField("ts", T.LongType()),
    T.StructField("xid", T.LongType()),
    T.StructField("xoffset", T.LongType()),
])

# What orders changes: the record's own fields, then its place in the topic, where known.
CHANGE_ORDER = ("ts", "xid", "xoffset", "partition", "offset")
SEQ = "seq"
SEQ_TYPE = T.ArrayType(T.LongType())
# The order of a joined row: the newest change among its inputs, then each of them.
VERSION = "version"
VERSION_TYPE = T.ArrayType(SEQ_TYPE)

ORDER_DETAIL = text_struct(*ORDER_DETAIL_COLUMNS, ROW_TIME)
PAY_DETAIL = text_struct(*PAY_DETAIL_COLUMNS, ROW_TIME)

TABLE_PROCESS = text_struct("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")

# The last change of a source table's routing row; ``after`` is null where it was deleted.
ROUTE_IMAGE = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("after", TABLE_PROCESS),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("seq", T.LongType()),
])

BASE_DIC = T.StructType([
    T.StructField("dic_code", T.StringType()),
    T.StructField("dic_name", T.StringType()),
    T.StructField("parent_code", T.StringType()),
    T.StructField("create_time", T.TimestampType()),
    T.StructField("operate_time", T.TimestampType()),
])


def _summary(texts, longs=(), doubles=(), transient=()):
    """Summary shape in sink column order; transient fields stay out of the sink."""
    fields = [T.StructField(n, T.StringType(), True, {"transient": True} if n in transient else None)
              for n in texts]
    fields += [T.StructField(n, T.LongType()) for n in longs]
    fields += [T.StructField(n, T.DoubleType()) for n in doubles]
    return T.StructType(fields + [T.StructField("ts", T.LongType())])


# --- fixed values: summary tables, in sink column order ----------------------------
VISIT_SUMMARY = _summary(
    ("stt", "edt", "vc", "ch", "ar"), ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"))
HOME_DETAIL_SUMMARY = _summary(("stt", "edt"), ("home_uv_ct", "good_detail_uv_ct"))
LOGIN_SUMMARY = _summary(("stt", "edt"), ("back_ct", "uu_ct"))
PAYER_SUMMARY = _summary(("stt", "edt"), ("unique_user_ct", "new_user_ct"))
PROVINCE_SUMMARY = _summary(
    ("stt", "edt", "province_id", "province_name"), ("order_count",), ("order_amount",))
USER_SPU_SUMMARY = _summary(
    ("stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name",
     "category2_id", "category2_name", "category3_id", "category3_name", "sku_id",
     "user_id", "spu_id", "spu_name"),
    ("order_count",), ("order_amount",), transient=("sku_id",))

VISIT_METRICS = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")


def dimension_schema(sink_columns, sink_pk=None, sink_extend=None):
    """All-text table shape from a configuration row's comma list.

    An absent key falls back to ``id`` and an absent extension to the empty text; both
    are kept as field metadata of the key column.
    """
    pk = sink_pk or "id"
    names = (sink_columns or "").split(",")
    if pk not in names:
        raise ValueError(f"key column {pk!r} is not in the column list {sink_columns!r}")
    return T.StructType([
        T.StructField(n, T.StringType(), True,
                      {"primary_key": True, "sink_extend": sink_extend or ""} if n == pk else None)
        for n in names
    ])
