"""Batch operators against brute force and hand-made edge cases."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from tideline import schemas
from tideline.functions import scalars, time as times
from tideline.operators import cdc, dedup, flags, joins, lookup, parse, windows
from tideline.operators.bounce import bounces
from tideline.sources.tables import read_query


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize("a, b, want", [
    ("2022-04-01 10:20:47.302Z", "2022-04-01 10:20:47.041Z", 1),
    ("2022-04-01 10:20:47.41Z", "2022-04-01 10:20:47.410Z", 0),
    ("2022-04-01 10:20:47.041Z", "2022-04-01 10:20:47.41Z", -1),
    ("2022-04-01 10:20:47Z", "2022-04-01 10:20:47.000Z", 0),
    ("2022-04-01 10:20:48Z", "2022-04-01 10:20:47.999Z", 1),
    ("bad", "2022-04-01 10:20:47Z", None),
])
def test_compare_row_times(spark, a, b, want):
    assert one(spark, times.compare_ltz3(F.lit(a), F.lit(b))) == want


def test_time_and_scalar_helpers(spark):
    assert one(spark, times.to_ts(F.lit("1970-01-02"))) == 86_400_000
    assert one(spark, times.to_ts(F.lit("1970-01-01 00:00:01"), full=True)) == 1000
    assert one(spark, times.to_ts(F.lit("nope"))) is None
    assert one(spark, times.to_ymdhms(F.lit(1000))) == "1970-01-01 00:00:01"
    assert one(spark, times.date_part_of(F.lit("2022-01-02 03:04:05"))) == "2022-01-02"
    assert one(spark, scalars.csv_contains(F.lit("id,tm_name"), F.lit("tm"))) is False
    assert one(spark, scalars.number_of(F.lit("x1"))) is None
    assert one(spark, scalars.set_size(F.array(F.lit("a"), F.lit(None), F.lit("a"), F.lit(None)))) == 2
    assert scalars.camel_case_name("CATEGORY3_ID") == "category3Id"
    before = one(spark, times.processing_millis())
    assert before <= one(spark, times.processing_millis())


def test_query_with_camel_case_names(spark):
    df = read_query(spark, "select 1 as tm_id, 'x' as spu_name", camel=True)
    assert df.columns == ["tmId", "spuName"]


def test_page_text_keeps_unknown_keys_and_null_error(spark):
    raw = spark.createDataFrame([
        ('{"err":null,"start":null,"displays":[1],"x":{"y":[1,"a"]},"ts":1}',), ('{"err":{"c":1}}',),
        ('{"start":"icon"}',), ("",), (None,), ("12",)], "value string")
    (text,) = (r.value for r in parse.page_view_text(raw).collect())
    assert json.loads(text) == {"start": None, "x": {"y": [1, "a"]}, "ts": 1}
    good, dirty = parse.split_dirty(raw)
    assert good.count() == 3 and dirty.count() == 3


def test_quoted_numbers_parse(spark):
    raw = spark.createDataFrame([('{"ts":"5","page":{"during_time":"7","page_id":"home"}}',)], "value string")
    row = parse.parse_page_log(raw).first()
    assert (row.ts, row.page.during_time, row.common) == (5, 7, None)


PAGES = "mid string, ts bigint, last string, arrival bigint"


def brute_bounces(data, within):
    out = []
    for mid in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == mid), key=lambda d: (d[1], d[3]))
        for row, nxt in zip(mine, [*mine[1:], None]):
            if row[2] is None and (nxt is None or nxt[2] is None or nxt[1] - row[1] >= within):
                out.append(row)
    return sorted(out, key=str)


def find_bounces(df, within, slices=6):
    return rows(bounces(df, "mid", "ts", "last", "arrival", within, slices))


def test_bounce_edges(spark):
    data = [("edge", 0, None, 1), ("edge", 10_000, "home", 2),       # exactly 10 s: timed out
            ("inside", 0, None, 1), ("inside", 9_999, "home", 2),    # a page in time
            ("two", 55_000, None, 1), ("two", 61_000, None, 2),      # pair across a slice
            ("tie", 0, None, 2), ("tie", 0, "home", 1),              # tie broken by arrival
            ("cut", 59_999, None, 1), ("cut", 60_000, "home", 2)]    # next row in the next slice
    got = find_bounces(spark.createDataFrame(data, PAGES), 10_000)
    assert got == brute_bounces(data, 10_000)
    assert {r[0] for r in got} == {"edge", "two", "tie"}


@pytest.mark.parametrize("slices", [1, 6])
def test_bounces_with_a_hot_key(spark, slices):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else f"m{rng.randrange(20)}", rng.randrange(0, 4_000_000),
             rng.choice([None, "home"]), i) for i in range(3000)]
    assert find_bounces(spark.createDataFrame(data, PAGES), 10_000, slices) == brute_bounces(data, 10_000)


def test_first_latest_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), (None, 1, 1, "n")],
                               "k string, t int, n int, v string")
    assert {r.v for r in dedup.latest_per_key(df, ("k",), ("t", "n")).collect()} == {"z", "n"}
    assert {r.v for r in dedup.first_per_key(df, ("k",), ("t", "n")).collect()} == {"x", "n"}


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                             "id")
    plan = dedup.latest_per_key(df, ("k",), ("id",))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_flags(spark):
    days = ["2022-01-01", "2022-01-01", "2022-01-08", "2022-01-16", "2022-01-17"]
    df = spark.createDataFrame([("u", d, i, i) for i, d in enumerate(days)],
                               "uid string, day string, ts bigint, arrival bigint")
    back = rows(flags.unique_and_returning(df, ("uid",)).select("day", "back_ct", "uu_ct"))
    assert back == [("2022-01-01", 0, 1), ("2022-01-08", 0, 1), ("2022-01-16", 1, 1), ("2022-01-17", 0, 1)]
    new = rows(flags.unique_and_new(df, ("uid",)).select("day", "new_user_ct"))
    assert new == [("2022-01-01", 1), ("2022-01-08", 0), ("2022-01-16", 0), ("2022-01-17", 0)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("slots", [1, 16])
def test_join_within_against_brute_force(spark, how, slots):
    rng = random.Random(7)
    def side(n, start):
        return [(("hot" if rng.random() < 0.3 else rng.choice(["a", "b", None])), start + i,
                 None if rng.random() < 0.05 else rng.randrange(0, 2000)) for i in range(n)]
    left, right = side(150, 0), side(150, 1000)
    timed = lambda data: spark.createDataFrame(data, "k string, id int, s bigint").withColumn(
        "t", F.timestamp_seconds("s"))
    got = joins.join_within(timed(left), timed(right), [("k", "k")], "t", "t", 5, how, slots=slots)
    want = []
    for l in left:
        hits = [r[1] for r in right if None not in (l[0], l[2], r[2]) and r[0] == l[0] and abs(r[2] - l[2]) <= 5]
        want += [(l[1], h) for h in hits] or ([(l[1], None)] if how == "left" else [])
    assert rows(got.select("id", "r_id")) == sorted(want, key=str)


def test_distinct_sum_counts_null_item_and_sums_exactly(spark):
    df = spark.createDataFrame([("p", "o1", 0.1, 0), ("p", "o1", 0.2, 1), ("p", None, 1.0, 2), ("p", "o2", None, 3),
                                ("p", "o1", 5.0, 10)], "k string, order_id string, order_amount double, s bigint")
    df = df.withColumn("event_time", F.timestamp_seconds("s"))
    got = rows(windows.with_bounds(windows.window_distinct_sum(df, ("k",)), stamp=False))
    assert got == [("1970-01-01 00:00:00", "1970-01-01 00:00:10", "p", 3, 1.3),
                   ("1970-01-01 00:00:10", "1970-01-01 00:00:20", "p", 1, 5.0)]


def test_partial_sums_equal_one_pass(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("event_time"),
                                            "id")
    summed = windows.window_sum_by(df, ("k",), ("id",), size="1 hour")
    assert summed.agg(F.sum("id")).first()[0] == sum(range(5000))


def test_lookup_missing_keys_and_forced_shuffle(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "key string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    assert rows(lookup.lookup_dim(df, dim, "key", {"n": "name"}, default="")) == [("1", "one"), ("9", ""), (None, "")]
    assert rows(lookup.lookup_dim(df, dim, "key", {"n": "name"}, on_missing="drop")) == [("1", "one")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = lookup.lookup_dim(df, dim, "key", {"n": "name"})
        assert "Broadcast" not in big._jdf.queryExecution().executedPlan().toString()
        assert rows(big) == [("1", "one"), ("9", None), (None, None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_config_latest_row_wins_and_delete_removes(spark):
    schema = "before struct<source_table:string,sink_table:string>, after struct<source_table:string," \
             "sink_table:string>, op string, ts_ms bigint, seq bigint"
    df = spark.createDataFrame([
        (None, ("a", "dim_a"), "r", 1, 0), (None, ("a", "dim_a2"), "u", 2, 0), (None, ("b", "dim_b"), "r", 1, 0),
        (("b", "dim_b"), None, "d", 3, 0)], schema)
    assert rows(cdc.latest_config(df)) == [("a", "dim_a2")]


def test_routing_prunes_and_latest_merges_columns(spark):
    changes = spark.createDataFrame([
        ("t", "insert", {"id": "1", "a": "x", "b": "o'k", "zz": "no"}, 1),
        ("t", "update", {"id": "1", "a": ""}, 2), ("t", "delete", {"id": "1"}, 3),
        ("other", "insert", {"id": "1"}, 1)], "table string, type string, data map<string,string>, seq bigint")
    config = spark.createDataFrame([("t", "dim_t", "id,a,b", "")],
                                   "source_table string, sink_table string, sink_columns string, sink_pk string")
    routed = cdc.route_by_config(cdc.filter_change_types(changes), config)
    assert sorted(map(sorted, (r.data for r in routed.collect()))) == [["a", "b", "id"], ["a", "id"]]
    logged = cdc.dimension_changes(routed, ("seq",))
    assert rows(cdc.latest_dimension(logged, schemas.dimension_schema("id,a,b"))) == [("1", None, "o'k")]


def test_dimension_schema_defaults():
    shape = schemas.dimension_schema("id,name", None, None)
    assert shape["id"].metadata == {"primary_key": True, "sink_extend": ""}
    with pytest.raises(ValueError):
        schemas.dimension_schema("a,b", "id")


def test_topic_names_agree():
    assert schemas.TOPIC_USER_JUMP == "dwd_traffic_user_jump" and schemas.TOPIC_PAGE_VIEW == "dwd_traffic_page_view"


def test_both_left_joins_of_order_details_use_one_exchange(spark):
    from tideline.plans.trade import join_order_detail
    side = "SELECT '1' AS id, '1' AS order_id, '1' AS order_detail_id, 'u' AS user_id, 'p' AS province_id, 'x' AS activity_id, " \
           "'y' AS activity_rule_id, 'z' AS coupon_id, timestamp_seconds(5) AS event_time"
    one = spark.sql(side).union(spark.sql(side).where("id = '2'"))
    sides = [one.select(*c, "event_time") for c in (
        ("id", "order_id"), ("id", "user_id", "province_id"), ("order_detail_id", "activity_id", "activity_rule_id"),
        ("order_detail_id", "coupon_id"))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_order_detail(*sides)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # Two for the orders, one for the details by id, one each for activities and coupons.
        assert plan.count("Exchange hashpartitioning") == 5
        assert "_slot" not in joined.columns
        assert [tuple(r)[:4] for r in joined.select("id", "user_id", "activity_id", "coupon_id").collect()] == [("1", "u", "x", "z")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
