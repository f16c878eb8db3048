"""Trade jobs: order and payment details, and three summaries.

Every function takes and returns DataFrames, batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.scalars import MONEY
from tideline.functions.time import date_part_of, processing_time, row_time
from tideline.operators.cdc import cdc_view, order_metric_rows, payment_success_view
from tideline.operators.dedup import first_per_key_windowed, latest_per_key_windowed
from tideline.operators.flags import unique_and_new
from tideline.operators.joins import join_within
from tideline.operators.lookup import lookup_as_of_now, lookup_chain, lookup_dim
from tideline.operators.windows import (
    WINDOW, window_distinct_sum, window_sum_all, with_bounds, with_event_time)
from tideline.schemas import (
    ORDER_ACTIVITY_CDC, ORDER_COUPON_CDC, ORDER_DETAIL_CDC, ORDER_DETAIL_COLUMNS, ORDER_INFO_CDC,
    PAY_DETAIL_COLUMNS, ROW_TIME, SEQ, VERSION)


def join_order_detail(details, orders, activities, coupons, seconds=5):
    """Order details with their order, activity and coupon.

    Each input has its event time in ``event_time``; other detail columns are carried. Where
    the inputs have their change order ``seq``, the result has a ``version``: the newest
    change among the four, then each of them.
    """
    ordered = SEQ in details.columns

    def seq_of(side):
        return [F.col(f"{side}_{SEQ}")] if ordered else []

    joined = join_within(details, orders, [("order_id", "id")], "event_time", "event_time",
                         seconds, "inner", "oi_")
    joined = joined.select(*details.columns, F.col("oi_user_id").alias("user_id"),
                           F.col("oi_province_id").alias("province_id"), *seq_of("oi"))
    carried = joined.columns
    joined = join_within(joined, activities, [("id", "order_detail_id")], "event_time", "event_time",
                         seconds, "left", "oa_", keep_slot=True)
    joined = joined.select(*carried, "_slot", F.col("oa_activity_id").alias("activity_id"),
                           F.col("oa_activity_rule_id").alias("activity_rule_id"), *seq_of("oa"))
    carried = [c for c in joined.columns if c != "_slot"]
    joined = join_within(joined, coupons, [("id", "order_detail_id")], "event_time", "event_time",
                         seconds, "left", "oc_")
    joined = joined.select(*carried, F.col("oc_coupon_id").alias("coupon_id"), *seq_of("oc"))
    if not ordered:
        return joined
    inputs = (SEQ, *(f"{side}_{SEQ}" for side in ("oi", "oa", "oc")))
    return joined.withColumn(VERSION, F.array(F.greatest(*inputs), *inputs)).drop(*inputs)


def name_source_type(joined, dictionary, keep=()):
    """Attach the source type name and put the detail table's columns in order."""
    named = lookup_as_of_now(joined, dictionary, "source_type", "source_type_name")
    return named.withColumnRenamed("source_type", "source_type_id").select(*ORDER_DETAIL_COLUMNS, *keep)


def joined_changes(changes, seconds=5, delay="5 seconds", database=None, keep=()):
    """The four change-log views of an order detail, joined."""
    def view(table, columns):
        rows = cdc_view(changes, table, columns, database, keep=keep)
        return with_event_time(rows, "create_time", delay)

    return join_order_detail(
        view("order_detail", ORDER_DETAIL_CDC),
        view("order_info", ORDER_INFO_CDC),
        view("order_detail_activity", ORDER_ACTIVITY_CDC),
        view("order_detail_coupon", ORDER_COUPON_CDC),
        seconds)


def order_detail(changes, dictionary, seconds=5, delay="5 seconds", database=None):
    """The order detail table from the change log."""
    joined = joined_changes(changes, seconds, delay, database)
    return name_source_type(joined, dictionary).withColumn(ROW_TIME, processing_time())


def join_payments(payments, details, seconds=905):
    """Successful payments with their order details, ``event_time`` on both."""
    return join_within(payments, details, [("order_id", "order_id")], "event_time", "event_time",
                       seconds, "inner", "od_")


def name_payment_type(joined, dictionary):
    """Attach the payment type name and put the payment table's columns in order."""
    named = lookup_as_of_now(joined, dictionary, "payment_type", "payment_type_name")
    names = {"order_detail_id": "od_id", "payment_type_code": "payment_type",
             "payment_type_name": "payment_type_name", "callback_time": "callback_time",
             "split_payment_amount": "od_split_total_amount"}
    version = []
    if SEQ in joined.columns:
        # The payment's own change, then what the order detail was made of.
        version = [F.concat(F.array(SEQ), f"od_{VERSION}").alias(VERSION)]
    return named.select(*(F.col(names.get(c, f"od_{c}")).alias(c) for c in PAY_DETAIL_COLUMNS),
                        F.col(f"od_{ROW_TIME}").alias(ROW_TIME), *version)


def joined_payments(changes, details, seconds=905, delay="905 seconds", database=None, keep=()):
    payments = with_event_time(payment_success_view(changes, database, keep), "callback_time", delay)
    return join_payments(payments, with_event_time(details, "create_time", delay), seconds)


def pay_detail(changes, details, dictionary, seconds=905, delay="905 seconds", database=None):
    """The payment success table from the change log and the order detail table."""
    return name_payment_type(joined_payments(changes, details, seconds, delay, database), dictionary)


def payer_flags(payments, tie=(), ttl_days=None):
    """First payment of the day per user, with unique and new flags.

    The latest version of each detail counts; the day is the text of the callback time.
    """
    timed = with_event_time(payments.withColumn("_version", row_time(ROW_TIME)), "callback_time", "2 seconds")
    needed = timed.select("order_detail_id", "user_id", "callback_time", "event_time", "_version", *tie)
    last = latest_per_key_windowed(needed, ("order_detail_id",), ("_version", *tie))
    rows = last.select("user_id", "callback_time", "event_time", "order_detail_id",
                       date_part_of("callback_time").alias("day"))
    return unique_and_new(rows, ("user_id",), "day", ("callback_time", "order_detail_id"),
                          ttl_days=ttl_days)


def payer_summary(payments, tie=(), size=WINDOW, stamp=True, ttl_days=None):
    """Users paying, and users paying for the first time."""
    flags = payer_flags(payments, tie, ttl_days)
    return with_bounds(window_sum_all(flags, ("unique_user_ct", "new_user_ct"), size=size), stamp)


def province_totals(details, tie=(), size=WINDOW):
    """Orders and amount per province, over the latest version of each detail."""
    timed = with_event_time(details.withColumn("_version", row_time(ROW_TIME)), "create_time", "2 seconds")
    needed = timed.select("id", "order_id", "province_id", "split_total_amount", "create_time", "event_time",
                          "_version", *tie)
    last = latest_per_key_windowed(needed, ("id",), ("_version", *tie))
    rows = order_metric_rows(last, ("province_id",), keep=("event_time",), kind=MONEY)
    return window_distinct_sum(rows, ("province_id",), size=size)


def name_provinces(totals, provinces, on_missing="keep"):
    return lookup_dim(totals, provinces, "province_id", {"province_name": "name"},
                      on_missing=on_missing, default="")


def province_summary(details, provinces, tie=(), size=WINDOW, stamp=True, on_missing="keep"):
    """Orders and amount per province; the name is looked up after the sums."""
    return with_bounds(name_provinces(province_totals(details, tie, size), provinces, on_missing), stamp)


def user_spu_rows(details, sku_info, tie=(), on_missing="keep"):
    """First version of each detail with the product, trademark and category of its sku."""
    return attach_sku(user_spu_first(details, tie, ("user_id", "sku_id")), sku_info, on_missing)


def user_spu_first(details, tie=(), keys=("user_id", "spu_id", "trademark_id", "category3_id")):
    """Metric row of the first version of each detail."""
    timed = with_event_time(details, "create_time", "2 seconds")
    order = tuple(tie) or (ROW_TIME,)
    needed = timed.select("id", "order_id", *keys, "split_total_amount", "create_time", "event_time", *order)
    first = first_per_key_windowed(needed, ("id",), order)
    return order_metric_rows(first, keys, keep=("event_time",), kind=MONEY)


def attach_sku(rows, sku_info, on_missing="keep"):
    columns = {"spu_id": "spu_id", "trademark_id": "tm_id", "category3_id": "category3_id"}
    return lookup_dim(rows, sku_info, "sku_id", columns, on_missing=on_missing)


def user_spu_totals(rows, size=WINDOW):
    return window_distinct_sum(rows, ("user_id", "spu_id", "trademark_id", "category3_id"), size=size)


def name_user_spu(totals, dims, on_missing="keep"):
    """Names of product, trademark and the three category levels, each keyed by the one before."""
    return lookup_chain(totals, [
        (dims["spu_info"], "spu_id", {"spu_name": "spu_name"}),
        (dims["base_trademark"], "trademark_id", {"trademark_name": "tm_name"}),
        (dims["base_category3"], "category3_id", {"category3_name": "name", "category2_id": "category2_id"}),
        (dims["base_category2"], "category2_id", {"category2_name": "name", "category1_id": "category1_id"}),
        (dims["base_category1"], "category1_id", {"category1_name": "name"}),
    ], on_missing)


def user_spu_summary(details, dims, tie=(), size=WINDOW, stamp=True, on_missing="keep"):
    """Orders and amount per user, product, trademark and category.

    ``dims`` holds ``sku_info``, ``spu_info``, ``base_trademark``, ``base_category3``,
    ``base_category2`` and ``base_category1``. The sku lookup supplies group keys; all
    others follow the sums, where rows are fewest.
    """
    totals = user_spu_totals(user_spu_rows(details, dims["sku_info"], tie, on_missing), size)
    return with_bounds(name_user_spu(totals, dims, on_missing), stamp)
