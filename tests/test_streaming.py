"""Stateful operators over several micro-batches."""

from __future__ import annotations

import glob
import json
import os
import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tideline.operators import dedup, flags
from tideline.operators.bounce import bounces
from tideline.operators.windows import window_sum_all, with_bounds, with_event_time
from tideline.plans.left_join import left_join_batch
from tideline.plans.traffic import visit_summary
from tideline.session import stream_session
from tideline.sinks.upsert import read_upsert
from tideline.streaming import gap
from tideline.streaming.run import run_with_restarts, start_query
from tideline.workload import batch, inputs, streams as workload
from tideline.workload.streams import replay, to_table

ONCE = {"availableNow": True}


class Feed:
    """A folder that is read as a stream, one run of the query per added batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, folder, schema
        spark.createDataFrame([], schema).write.parquet(f"{folder}/in")

    def stream(self):
        shape = self.spark.createDataFrame([], self.schema).schema
        return self.spark.readStream.schema(shape).parquet(f"{self.folder}/in")

    def add(self, data):
        self.spark.createDataFrame(data, self.schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def run(self, df, trigger=None):
        start_query(df, f"{self.folder}/cp", fmt="parquet", path=f"{self.folder}/out",
                    trigger=trigger or ONCE).awaitTermination()
        return sorted((tuple(r) for r in self.spark.read.schema(df.schema).parquet(f"{self.folder}/out").collect()),
                      key=str)


def test_bounces_over_batches_with_a_late_row(streams, folder):
    feed = Feed(streams, folder, "mid string, ts bigint, last string, arrival bigint")
    base = 60_000_000
    def found():
        return bounces(feed.stream(), "mid", "ts", "last", "arrival").select("mid", (F.col("ts") - base).alias("ts"))
    def add(*data):
        feed.add([(mid, base + ts, last, i) for i, (mid, ts, last) in enumerate(data)])
    add(("a", 0, None), ("b", 0, None), ("c", 58_000, None))
    assert feed.run(found()) == [("a", 0), ("b", 0)]        # the watermark, 56 s, has passed both by 10 s
    add(("c", 61_000, "home"), ("a", 1_000, "home"))        # the row of a comes too late
    add(("z", 500_000, "home"))
    assert feed.run(found()) == [("a", 0), ("b", 0)]        # c went on to a page, across a slice
    add(("d", 500_500, None), ("d", 501_000, None))
    add(("z", 900_000, "home"))
    assert feed.run(found()) == [("a", 0), ("b", 0), ("d", 500_500), ("d", 501_000)]


def test_bounces_against_brute_force_over_batches(streams, folder):
    feed = Feed(streams, folder, "mid string, ts bigint, last string, arrival bigint, more map<string,string>")
    draw = random.Random(4)
    base, rows = 60_000_000, []
    for arrival in range(600):
        last = draw.choice([None, "home"])
        rows.append((draw.choice("aab"), base + arrival * 900 + draw.randrange(0, 1_800, 300), last, arrival, {"k": "v"}))
    want = []
    for mid in "ab":
        mine = sorted((r for r in rows if r[0] == mid), key=lambda r: (r[1], r[3]))
        for row, after in zip(mine, [*mine[1:], None]):
            if row[2] is None and (after is None or after[2] is None or after[1] - row[1] >= 10_000):
                want.append((mid, row[1], row[3]))
    found = lambda: bounces(feed.stream(), "mid", "ts", "last", "arrival").select("mid", "ts", "arrival")
    for part in range(0, 600, 150):
        feed.add(rows[part:part + 150])
        feed.run(found())
    feed.add([("z", base + 10_000_000, "home", 0, None), (None, None, None, 0, None)])
    assert feed.run(found()) == sorted(want, key=str)
    query = found().writeStream.format("noop").option("checkpointLocation", f"{folder}/noop").trigger(**ONCE).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "ObjectHashAggregate" in plan and "Python" not in plan


DAYS = "uid string, day string, ts bigint, arrival bigint"
DAY_MS = 86_400_000


def day_rows(*entries):
    return [(uid, f"1970-01-{d + 1:02d}", d * DAY_MS + ms, i) for i, (uid, d, ms) in enumerate(entries)]


def test_daily_flags_then_window_over_batches(streams, folder):
    feed = Feed(streams, folder, DAYS)
    def summed():
        timed = with_event_time(feed.stream(), "ts")
        marked = flags.unique_and_returning(timed, ("uid",), gap=8)
        return with_bounds(window_sum_all(marked, ("back_ct", "uu_ct"), size="1 day"), stamp=False)
    feed.add(day_rows(("u", 0, 5), ("u", 0, 1), ("v", 0, 7)))
    feed.run(summed())
    feed.add(day_rows(("u", 0, 900), ("u", 7, 1)))
    feed.run(summed())
    feed.add(day_rows(("u", 15, 1), ("v", 7, 5), ("v", 20, 1)))
    feed.run(summed())
    feed.add(day_rows(("z", 28, 1)))
    assert feed.run(summed()) == [
        ("1970-01-01 00:00:00", "1970-01-02 00:00:00", 0, 2), ("1970-01-08 00:00:00", "1970-01-09 00:00:00", 0, 2),
        ("1970-01-16 00:00:00", "1970-01-17 00:00:00", 1, 1), ("1970-01-21 00:00:00", "1970-01-22 00:00:00", 1, 1)]


def test_day_state_expires_in_event_time(streams, folder):
    """After its time to live a key counts as new again; without one it never does."""
    got = {}
    for ttl in (None, 2):
        feed = Feed(streams, f"{folder}/{ttl}", DAYS)
        def new():
            timed = with_event_time(feed.stream(), "ts")
            return flags.unique_and_new(timed, ("uid",), ttl_days=ttl).select("uid", "day", "new_user_ct")
        feed.add(day_rows(("u", 0, 1)))
        feed.run(new())
        feed.add(day_rows(("z", 5, 1)))
        feed.run(new())
        feed.add(day_rows(("u", 6, 1)))
        got[ttl] = [r[2] for r in feed.run(new()) if r[0] == "u"]
    assert got == {None: [1, 0], 2: [1, 1]}


VERSIONS = "id string, n bigint, arrival bigint"


def test_first_row_passes_again_after_silence(streams, folder):
    feed = Feed(streams, folder, VERSIONS)
    once = {"once": True}
    first = lambda: dedup.first_per_key_ttl(feed.stream(), ("id",), ("n",), ttl_ms=15_000)
    feed.add([("a", 2, 0), ("a", 1, 1), ("b", 1, 2)])
    assert [r[:2] for r in feed.run(first(), once)] == [("a", 1), ("b", 1)]
    feed.add([("a", 3, 0)])
    assert len(feed.run(first(), once)) == 2
    time.sleep(15)
    feed.add([("a", 4, 0)])
    assert [r[:2] for r in feed.run(first(), once)] == [("a", 1), ("a", 4), ("b", 1)]


def test_latest_row_is_held_then_emitted(streams, folder):
    feed = Feed(streams, folder, VERSIONS)
    once = {"once": True}
    last = lambda: dedup.latest_per_key_hold(feed.stream(), ("id",), ("n", "arrival"), hold_ms=1500)
    feed.add([("a", 1, 0), ("a", 3, 0), ("a", 3, 1), ("d", 3, 0), ("d", None, 1)])
    feed.run(last(), once)
    feed.add([("a", 2, 9), ("b", 1, 0)])
    time.sleep(2)
    feed.run(last(), once)
    time.sleep(2)
    feed.add([("c", 1, 0)])
    # A null order value comes before any other.
    assert feed.run(last(), once) == [("a", 3, 1), ("b", 1, 0), ("d", 3, 0)]


def test_late_row_is_dropped_from_closed_window(streams, folder):
    feed = Feed(streams, folder, "ts bigint, n bigint")
    def summed():
        return with_bounds(window_sum_all(with_event_time(feed.stream(), "ts"), ("n",)), stamp=False)
    feed.add([(1_000, 1), (9_000, 1), (11_000, 1), (13_000, 1)])
    assert [r[2] for r in feed.run(summed())] == [2]
    feed.add([(2_000, 5), (12_500, 1)])
    feed.add([(60_000, 1)])
    assert [r[2] for r in feed.run(summed())] == [2, 3]


@pytest.mark.parametrize("column, schema, data", [
    ("at", "at string, n bigint", [("1970-01-01 00:00:01", 1), ("1970-01-01 00:00:30", 1)]),
])
def test_event_time_from_text(streams, folder, column, schema, data):
    feed = Feed(streams, folder, schema)
    feed.add(data)
    summed = window_sum_all(with_event_time(feed.stream(), column), ("n",))
    assert feed.run(with_bounds(summed, stamp=False)) == [("1970-01-01 00:00:00", "1970-01-01 00:00:10", 1)]


def test_pages_ahead_of_visitors_and_bounces_close_no_window(streams, folder):
    common = {"mid": "m", "uid": None, "vc": "v", "ch": "c", "ar": "1"}
    schema = ("common struct<mid: string, uid: string, vc: string, ch: string, ar: string>, "
              "page struct<page_id: string, last_page_id: string, during_time: bigint>, ts bigint")
    feeds = [Feed(streams, f"{folder}/{name}", schema) for name in ("visitors", "jumps", "pages")]

    def step(*times):
        for feed, at in zip(feeds, times):
            if at is not None:
                feed.add([(common, ("home", None, 10), at)])
        summary = visit_summary(*(feed.stream() for feed in feeds), stamp=False)
        start_query(summary, f"{folder}/cp", fmt="parquet", path=f"{folder}/out", trigger=ONCE).awaitTermination()
        rows = streams.read.schema(summary.schema).parquet(f"{folder}/out").where("stt = '1970-01-01 00:00:00'")
        return [(r.uv_ct, r.uj_ct) for r in rows.collect()]

    assert step(None, None, 0) == []
    assert step(None, None, 25_000) == []
    assert step(0, None, None) == []
    assert step(None, 0, None) == []
    assert step(60_000, 60_000, 60_000) == [(1, 1)]


def test_left_join_with_either_side_first(streams, folder):
    """Sent 1-a, 1-b, 2-b, 2-a: each side may come first."""
    feed = Feed(streams, folder, "id string, name string, seq array<bigint>, side string")
    for row in [("1", "a", [1], "a"), ("1", "b", [1], "b"), ("2", "bb", [1], "b"), ("2", "zz", [1], "a")]:
        # A later change of the same key in the same batch; its text is the smaller one.
        feed.add([row, ("2", "aa", [2], "a")] if row[1] == "zz" else [row])
        start_query(feed.stream(), f"{folder}/cp", each_batch=left_join_batch(folder),
                    trigger=ONCE).awaitTermination()
    joined = read_upsert(streams, f"{folder}/joined", ("id_a",))
    assert sorted(tuple(r) for r in joined.collect()) == [("1", "1", "a", "b"), ("2", "2", "aa", "bb")]


def test_restart_resumes_and_gives_up(streams, folder):
    feed = Feed(streams, folder, "n bigint")
    feed.add([(1,), (2,)])
    tries = []

    def each_batch(batch, batch_id):
        tries.append(batch_id)
        if len(tries) < 3:
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch_id={batch_id}")

    start = lambda: start_query(feed.stream(), f"{folder}/cp", each_batch=each_batch, trigger=ONCE)
    run_with_restarts(start, restarts=3, wait_seconds=0.1)
    assert tries == [0, 0, 0]
    assert streams.read.parquet(f"{folder}/out").agg(F.sum("n")).first()[0] == 3
    feed.add([(3,)])
    tries.clear()
    with pytest.raises(StreamingQueryException):
        run_with_restarts(start, restarts=1, wait_seconds=0.1)


def test_keys_of_a_bucket_share_one_state_call():
    """Thousands of keys cost one read and one write of state, and live ones do not pass again."""
    class Live:
        value, calls = None, 0

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value, self.calls = value, self.calls + 1

    class Clock:
        now = 1_000

        def getCurrentProcessingTimeInMs(self):
            return self.now

    import pyarrow as pa
    processor, clock = gap.FirstAfterSilence(["id"], ["n"], 500), Clock()
    processor.live = Live()

    def passed(ids, now):
        clock.now = now
        rows = pa.table({"id": pa.array([*ids, *ids], pa.string()), "n": [2] * len(ids) + [1] * len(ids)})
        out = list(processor.handleInputRows((0,), iter([{"rows": gap._bytes(rows)}]), clock))
        return sorted((r for row in out for r in gap._table(row["rows"]).to_pylist()), key=str)

    ids = [f"k{i}" for i in range(5_000)] + [None]
    assert passed(ids, 1_000) == sorted(({"id": i, "n": 1} for i in ids), key=str)
    assert processor.live.calls == 1
    assert passed([None, "k1", "new"], 1_400) == [{"id": "new", "n": 1}]
    assert passed(["k2", "k1", None], 1_500) == [{"id": "k2", "n": 1}]      # k1 and null were renewed


def test_replay_arrives_in_slices_of_event_time(spark, streams, folder):
    rows = spark.range(400).selectExpr("timestamp_seconds(id * 37 % 400) AS t", "id AS n").withColumn("n", F.col("n") % 7)
    late = spark.sql("SELECT timestamp_seconds(9000) AS t, 0L AS n")
    feed = replay(streams, rows, f"{folder}/in", late, F.col("t"), slices=4)
    out = to_table(spark, with_bounds(window_sum_all(with_event_time(feed, "t"), ("n",)), stamp=False), folder,
                   feeds=[f"{folder}/in"])
    want = with_bounds(window_sum_all(with_event_time(rows, "t"), ("n",)), stamp=False)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    steps = [json.loads(line) for file in sorted(glob.glob(f"{folder}/checkpoint/sources/0/[0-9]*"))
             for line in open(file) if line.startswith("{")]
    assert len({step["batchId"] for step in steps}) == 4


def test_slices_run_in_one_query_in_the_order_of_their_ranges(spark, streams, folder, monkeypatch):
    """A restart for each slice would read the state of all slices before it again."""
    starts = []
    monkeypatch.setattr(workload, "start_query", lambda *a, **k: starts.append(1) or start_query(*a, **k))
    rows = spark.range(400).selectExpr("timestamp_seconds(id * 37 % 400) AS t", "id % 7 AS n")
    late = spark.sql("SELECT timestamp_seconds(9000) AS t, 0L AS n")
    feed = replay(streams, workload.in_slices(4)(rows, "t"), f"{folder}/in", late, slices=4)
    query = with_bounds(window_sum_all(with_event_time(feed, "t"), ("n",)), stamp=False)
    out = to_table(spark, query, folder, feeds=[f"{folder}/in"])
    want = with_bounds(window_sum_all(with_event_time(rows, "t"), ("n",)), stamp=False)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    assert len(starts) == 1
    ages = [os.path.getmtime(part) for part in sorted(glob.glob(f"{folder}/in/part-*"))]
    assert all(a < b for a, b in zip(ages, ages[1:]))


def test_slices_follow_one_another_where_files_keep_no_age(spark, streams, folder, monkeypatch):
    monkeypatch.setattr(workload, "age_parts", lambda *a: False)
    rows = spark.range(400).selectExpr("timestamp_seconds(id * 37 % 400) AS t", "id % 7 AS n")
    late = spark.sql("SELECT timestamp_seconds(9000) AS t, 0L AS n")
    feed = replay(streams, workload.in_slices(4)(rows, "t"), f"{folder}/in", late, slices=4)
    query = with_bounds(window_sum_all(with_event_time(feed, "t"), ("n",)), stamp=False)
    out = to_table(spark, query, folder, feeds=[f"{folder}/in"])
    want = with_bounds(window_sum_all(with_event_time(rows, "t"), ("n",)), stamp=False)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(n).getName() for n in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffle_files_go_with_the_micro_batch(spark, folder):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    before = _shuffle_files(spark)
    rows = spark.range(400).selectExpr("timestamp_seconds(id) AS t", "id % 7 AS n")
    feed = replay(session, workload.in_slices(2)(rows, "t"), f"{folder}/in", slices=2)
    to_table(spark, with_bounds(window_sum_all(with_event_time(feed, "t"), ("n",)), stamp=False), folder)
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert glob.glob(f"{folder}/in/*.zstd.parquet")


def _tables(spark):
    sql = spark.sql
    return {
        "customer": sql("SELECT 1L AS c_custkey, 3L AS c_nationkey"),
        "orders": sql("SELECT 5L AS o_orderkey, 1L AS o_custkey, 'F' AS o_orderstatus, 1D AS o_totalprice, "
                      "timestamp_ntz'1995-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority"),
        "lineitem": sql("SELECT 5L AS l_orderkey, 1 AS l_linenumber, 7L AS l_partkey, 9L AS l_suppkey, 2D AS l_quantity, "
                        "1D AS l_extendedprice, 'R' AS l_returnflag, timestamp_ntz'1995-02-01 00:00:00' AS l_shipdate"),
    }


def test_closing_row_reads_no_lines(spark, folder, monkeypatch):
    """The rows are joined once, to be written; the last time is that of the orders."""
    tables, calls, order_lines = _tables(spark), [], inputs.order_lines
    monkeypatch.setattr(inputs, "table", lambda spark, sf, name: tables[name])
    monkeypatch.setattr(inputs, "order_lines", lambda *a: calls.append(1) or order_lines(*a))
    workload.detail_stream(spark, stream_session(spark), None, f"{folder}/in")
    found = spark.read.parquet(f"{folder}/in").select("id", "create_time").collect()
    assert sorted(map(tuple, found)) == [("5-1", "1995-01-01 00:00:05"), (workload.END, "1995-04-01 00:00:05")]
    assert len(calls) == 1


def test_upsert_of_details_leaves_no_shuffle_files(spark, monkeypatch):
    tables = _tables(spark)
    monkeypatch.setattr(inputs, "table", lambda spark, sf, name: tables[name])
    monkeypatch.setattr(inputs, "base_dic", lambda *a: spark.sql("SELECT '5' AS dic_code, 'five' AS dic_name"))
    before = _shuffle_files(spark)
    found = batch.order_detail_upsert(spark, None)
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert [(r.id, r.user_id, r.coupon_id, r.source_type_name) for r in found.collect()] == [("5-1", "1", "7", "five")]
