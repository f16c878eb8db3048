"""The twelve jobs end to end on file topics."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from tideline import schemas
from tideline.plans import jobs
from tideline.sinks.routes import fold_routes, read_routes
from tideline.sinks.summary import read_summary
from tideline.sinks.upsert import read_upsert
from tideline.sources.topics import CONFIG_ENVELOPE as ROUTE_ENVELOPE

# 2022-05-14 00:00:00 UTC
T0 = 1652486400000


def page(mid, ms, page_id, last=None, uid="7", **more):
    return json.dumps({"common": {"mid": mid, "uid": uid, "vc": "v1", "ch": "web", "ar": "11", "is_new": "1"},
                       "page": {"page_id": page_id, "last_page_id": last, "during_time": 100},
                       "ts": T0 + ms, **more})


def change(table, data, kind="insert", database="shop", xid=1):
    return json.dumps({"database": database, "table": table, "type": kind, "ts": 1, "xid": xid, "commit": True,
                       "data": data, "old": {}})


def route(source, columns):
    return json.dumps({"before": None, "op": "r", "ts_ms": 1, "seq": 0, "after": {
        "source_table": source, "sink_table": f"dim_{source}", "sink_columns": columns,
        "sink_pk": "id", "sink_extend": None}})


@pytest.fixture
def warehouse(streams, folder):
    return jobs.Warehouse(streams, folder, f"{folder}/checkpoints", database="shop",
                          trigger={"availableNow": True}).prepare()


def put(w, topic, lines):
    rows = w.spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    rows.write.mode("append").text(f"{w.topics}/{topic}")


def spoil(folder, suffix, content):
    """Overwrite the files below a folder in place."""
    for path in Path(folder).rglob(f"*{suffix}"):
        path.write_bytes(content)
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)


def finish(*queries):
    for query in queries:
        query.awaitTermination()


def values(w, topic):
    return sorted(r.value for r in w.spark.read.text(f"{w.topics}/{topic}").collect() if r.value)


def test_traffic_jobs(warehouse):
    w = warehouse
    put(w, schemas.TOPIC_LOG, [
        page("m1", 0, "home", extra={"k": 1}),
        page("m1", 3_000, "good_detail", "home", displays=[1], actions=[2]),
        page("m2", 1_000, "home", uid=None),
        page("m2", 20_000, "home", uid=None),
        page("m3", 2_000, "home", err={"code": 1}),
        page("m3", 2_000, "home", start={"entry": "icon"}),
        "oops", "[1]",
        page("zz", 3_600_000, "cart", "home"),
    ])
    finish(*jobs.page_view_job(w))
    pages = values(w, schemas.TOPIC_PAGE_VIEW)
    assert len(pages) == 5
    assert not any("displays" in p or "actions" in p for p in pages)
    assert any('"extra":{"k":1}' in p and '"is_new":"1"' in p for p in pages)
    assert values(w, "dirty_log") == ["[1]", "oops"]

    finish(jobs.unique_visitor_job(w), jobs.bounce_job(w))
    visitors = [json.loads(v) for v in values(w, schemas.TOPIC_UNIQUE_VISITOR)]
    assert sorted((v["common"]["mid"], v["ts"] - T0) for v in visitors) == [("m1", 0), ("m2", 1_000)]
    jumps = [json.loads(v) for v in values(w, schemas.TOPIC_USER_JUMP)]
    assert sorted((v["common"]["mid"], v["ts"] - T0) for v in jumps) == [("m2", 1_000), ("m2", 20_000)]

    finish(jobs.visit_summary_job(w), jobs.home_detail_job(w), jobs.login_job(w))
    visit = read_summary(w.spark, f"{w.root}/summaries/traffic_vc_ch_ar_page_view_window")
    assert visit.columns == schemas.VISIT_SUMMARY.names
    # Pages are an hour ahead, but the last bounce and visitor known are of the first seconds.
    assert visit.count() == 0
    home = read_summary(w.spark, f"{w.root}/summaries/traffic_page_view_window")
    assert [tuple(r)[:-1] for r in home.collect()] == [("2022-05-14 00:00:00", "2022-05-14 00:00:10", 2, 1)]
    # m1's entry is the one login event, so nothing has moved the watermark past it yet.
    assert read_summary(w.spark, f"{w.root}/summaries/user_user_login_window").count() == 0
    put(w, schemas.TOPIC_LOG, [page("zz", 3_700_000, "home", "login", uid="8")])
    finish(*jobs.page_view_job(w))
    finish(jobs.login_job(w))
    login = read_summary(w.spark, f"{w.root}/summaries/user_user_login_window")
    assert [tuple(r)[:-1] for r in login.collect()] == [("2022-05-14 00:00:00", "2022-05-14 00:00:10", 0, 1)]

    # A later visitor and a later bounce let the windows before them close.
    put(w, schemas.TOPIC_LOG, [page("zy", 7_200_000, "home"), page("zx", 10_800_000, "home")])
    finish(*jobs.page_view_job(w))
    finish(jobs.unique_visitor_job(w), jobs.bounce_job(w))
    finish(jobs.visit_summary_job(w))
    visit = read_summary(w.spark, f"{w.root}/summaries/traffic_vc_ch_ar_page_view_window")
    assert sorted(tuple(r)[:-1] for r in visit.collect()) == [
        ("2022-05-14 00:00:00", "2022-05-14 00:00:10", "v1", "web", "11", 2, 2, 3, 300, 1),
        ("2022-05-14 00:00:20", "2022-05-14 00:00:30", "v1", "web", "11", 0, 1, 1, 100, 1),
        ("2022-05-14 01:00:00", "2022-05-14 01:00:10", "v1", "web", "11", 0, 0, 1, 100, 0),
        ("2022-05-14 01:01:40", "2022-05-14 01:01:50", "v1", "web", "11", 0, 0, 1, 100, 0)]


def test_last_change_wins_in_one_batch_and_bad_routes_are_set_aside(warehouse):
    w = warehouse
    put(w, "table_process", [route("base_trademark", "id,tm_name"), route("sku_info", None)])
    put(w, schemas.TOPIC_DB, [change("elsewhere", {"id": "1"})])
    jobs.run_job(jobs.dim_job, w)
    names = lambda: sorted(tuple(r) for r in w.dimension("base_trademark", "id,tm_name").collect())
    assert names() == []
    bad = w.spark.read.json(f"{w.root}/dims/bad_routes").collect()
    assert [r["source_table"] for r in bad] == ["sku_info"]

    put(w, schemas.TOPIC_DB, [
        change("base_trademark", {"id": "1", "tm_name": "apple"}, "update", xid=9),
        change("base_trademark", {"id": "1", "tm_name": "zebra"}, xid=2),
        change("base_trademark", {"id": "2", "tm_name": "old"}, xid=2),
        change("base_trademark", {"id": "2", "tm_name": ""}, "update", xid=10)])
    jobs.run_job(jobs.dim_job, w)
    assert names() == [("1", "apple"), ("2", None)]


def test_routes_are_folded_and_old_ones_not_read_again(warehouse):
    w = warehouse

    def deleted(source, ms):
        return json.dumps({"before": {"source_table": source}, "after": None, "op": "d", "ts_ms": ms, "seq": 0})

    def later(line, ms):
        return json.dumps({**json.loads(line), "ts_ms": ms})

    def run(routes, changes):
        put(w, schemas.TABLE_PROCESS_TOPIC, routes)
        put(w, schemas.TOPIC_DB, changes)
        jobs.run_job(jobs.dim_job, w)
        return {r["source_table"]: r["sink_columns"] for r in read_routes(w.spark, f"{w.root}/dims").collect()}

    def names():
        return sorted(tuple(r) for r in w.dimension("base_trademark", "id,tm_name").collect())

    mark = lambda n: change("base_trademark", {"id": n, "tm_name": n}, xid=int(n))
    assert run([route("base_trademark", "id,tm_name"), route("sku_info", "id")], [mark("1")]) == {
        "base_trademark": "id,tm_name", "sku_info": "id"}
    # A route holds for the changes of its own batch; an older image does not win over a delete.
    assert run([deleted("base_trademark", 5), later(route("base_trademark", "id"), 3)], [mark("2")]) == {"sku_info": "id"}
    assert run([later(route("base_trademark", "id,tm_name"), 4)], [mark("3")]) == {"sku_info": "id"}
    assert names() == [("1", "1")]
    assert run([later(route("base_trademark", "id,tm_name"), 6)], [mark("4")]) == {
        "base_trademark": "id,tm_name", "sku_info": "id"}
    assert names() == [("1", "1"), ("4", "4")]

    # History is not read: with its files made unreadable, new changes still find their routes.
    spoil(f"{w.topics}/{schemas.TABLE_PROCESS_TOPIC}", ".txt", b'{"after":{"source_table":"spoilt"},"ts_ms":99}')
    put(w, schemas.TOPIC_DB, [mark("5")])
    jobs.run_job(jobs.dim_job, w)
    assert names() == [("1", "1"), ("4", "4"), ("5", "5")]
    # A batch folded again gives the same snapshot.
    again = w.spark.createDataFrame([], ROUTE_ENVELOPE)
    fold_routes(again, f"{w.root}/dims", 9)
    assert read_routes(w.spark, f"{w.root}/dims").count() == 2


def test_trade_jobs(warehouse):
    w = warehouse
    put(w, "table_process", [
        route("base_province", "id,name"), route("sku_info", "id,spu_id,tm_id,category3_id"),
        route("spu_info", "id,spu_name"), route("base_trademark", "id,tm_name"),
        route("base_category3", "id,name,category2_id"), route("base_category2", "id,name,category1_id"),
        route("base_category1", "id,name")])
    w.spark.createDataFrame([("2405", "search"), ("1101", "card")], "dic_code string, dic_name string") \
        .write.parquet(f"{w.root}/lookup/base_dic")
    detail = {"id": "1", "order_id": "10", "sku_id": "5", "sku_name": "phone", "order_price": "8.5",
              "sku_num": "2", "create_time": "2022-05-14 00:00:01", "source_type": "2405",
              "split_total_amount": "17.0"}
    order = {"id": "10", "user_id": "57", "province_id": "1", "create_time": "2022-05-14 00:00:00"}
    late, later = {"create_time": "2022-05-14 02:00:00"}, {"create_time": "2022-05-14 05:00:00"}
    put(w, schemas.TOPIC_DB, [
        change("base_province", {"id": "1", "name": "Beijing", "area_code": "x"}),
        change("sku_info", {"id": "5", "spu_id": "3", "tm_id": "2", "category3_id": "61", "price": "1"}),
        change("spu_info", {"id": "3", "spu_name": "spu three"}),
        change("base_trademark", {"id": "2", "tm_name": "O'Neil", "logo_url": "/a"}),
        change("base_category3", {"id": "61", "name": "c3", "category2_id": "13"}),
        change("base_category2", {"id": "13", "name": "c2", "category1_id": "2"}),
        change("base_category1", {"id": "2", "name": "c1"}),
        change("order_info", order), change("order_detail", detail),
        change("order_detail", {**detail, "id": "2", "sku_id": "9", "split_total_amount": "1.5"}),
        change("order_detail", {**detail, "id": "3"}, database="elsewhere"),
        change("order_detail", {**detail, "id": "4"}, kind="update"),
        change("order_detail_activity", {"id": "a", "order_detail_id": "1", "activity_id": "2",
                                         "activity_rule_id": "4", "create_time": "2022-05-14 00:00:01"}),
        change("payment_info", {"user_id": "57", "order_id": "10", "payment_type": "1101",
                                "callback_time": "2022-05-14 00:10:00", "payment_status": "1602"}, "update"),
        # The last rows of each kind, which move the watermarks.
        change("order_info", {**order, **late, "id": "90"}),
        change("order_detail", {**detail, **late, "id": "9", "order_id": "90"}),
        change("order_detail_activity", {"id": "z", "order_detail_id": "zz", **late}),
        change("order_detail_coupon", {"id": "z", "order_detail_id": "zz", **late}),
        change("payment_info", {"user_id": "58", "order_id": "90", "payment_type": "1101",
                                "callback_time": "2022-05-14 02:00:00", "payment_status": "1602"}, "update"),
    ])
    finish(jobs.dim_job(w))
    names = w.dimension("base_trademark", "id,tm_name").collect()
    assert [tuple(r) for r in names] == [("2", "O'Neil")]

    finish(jobs.order_detail_job(w))
    rows = read_upsert(w.spark, f"{w.root}/tables/{schemas.TOPIC_ORDER_DETAIL}", ("id",)).collect()
    got = {r.id: (r.user_id, r.province_id, r.activity_id, r.coupon_id, r.source_type_name) for r in rows}
    assert got["1"] == ("57", "1", "2", None, "search") and got["2"][2] is None

    # Resumed from its checkpoint, the job emits the late rows once even later ones come.
    put(w, schemas.TOPIC_DB, [
        change("order_info", {**order, **later, "id": "91"}),
        change("order_detail", {**detail, **later, "id": "10", "order_id": "91"}),
        change("order_detail_activity", {"id": "y", "order_detail_id": "yy", **later}),
        change("order_detail_coupon", {"id": "y", "order_detail_id": "yy", **later})])
    finish(jobs.order_detail_job(w))
    rows = read_upsert(w.spark, f"{w.root}/tables/{schemas.TOPIC_ORDER_DETAIL}", ("id",)).collect()
    assert sorted(r.id for r in rows) == ["1", "2", "9"]

    finish(jobs.pay_detail_job(w))
    paid = read_upsert(w.spark, f"{w.root}/tables/{schemas.TOPIC_PAY_DETAIL}", ("order_detail_id",)).collect()
    assert sorted((r.order_detail_id, r.payment_type_name) for r in paid) == [
        ("1", "card"), ("2", "card"), ("9", "card")]

    finish(jobs.payer_job(w), jobs.province_job(w), *jobs.user_spu_job(w))
    def read(name):
        return [tuple(r)[:-1] for r in read_summary(w.spark, f"{w.root}/summaries/{name}").collect()]
    assert read("trade_payment_suc_window") == [("2022-05-14 00:10:00", "2022-05-14 00:10:10", 1, 1)]
    bounds = ("2022-05-14 00:00:00", "2022-05-14 00:00:10")
    assert read("trade_province_order_window") == [(*bounds, "1", "Beijing", 1, 18.5)]
    assert sorted(read("trade_user_spu_order_window"), key=str) == sorted([
        (*bounds, "2", "O'Neil", "2", "c1", "13", "c2", "61", "c3", "57", "3", "spu three", 1, 17.0),
        (*bounds, *[None] * 8, "57", None, None, 1, 1.5)], key=str)


def test_failure_of_any_query_restarts_the_job():
    from types import SimpleNamespace

    from pyspark.errors import StreamingQueryException

    class Query:
        def __init__(self, fails):
            self.fails, self.stopped = fails, False

        def awaitTermination(self, timeout=None):
            if self.fails:
                raise StreamingQueryException("lost")
            # An endless query, until its job has been started again.
            assert timeout is not None
            return len(started) > 1

        def stop(self):
            self.stopped = True

    started = []

    def job(w):
        started.append((Query(False), Query(not started)))
        return started[-1]

    jobs.run_job(job, SimpleNamespace(restarts=1))
    assert len(started) == 2
    assert [q.stopped for q in started[0]] == [True, True]
