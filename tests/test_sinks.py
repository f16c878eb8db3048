"""Upsert tables, dimensions, summaries, topics and taps."""

from __future__ import annotations

import glob
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideline import schemas
from tideline.operators import lookup
from tideline.sinks import dimension, summary, taps, topics, upsert
from tideline.sources import tables
from tideline.sources.topics import read_json_stream, read_text_stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data, schema="id string, v string, n int"):
    return spark.createDataFrame(data, schema)


def test_upsert_retry_delete_and_compaction(spark, folder):
    def write(batch_id, data):
        df = frame(spark, data)
        upsert.upsert_batch(df, folder, ("id",), ("n",), batch_id, F.col("v").isNull())

    def read():
        return [r[:2] for r in rows(upsert.read_upsert(spark, folder, ("id",)))]

    write(0, [("a", "1", 1), ("a", "2", 2), ("b", "1", 1)])
    assert read() == [("a", "2"), ("b", "1")]
    write(1, [("a", "wrong", 0)])
    write(1, [("a", "0", 0), ("c", "1", 1)])     # the batch again, after a failure
    assert read() == [("a", "0"), ("b", "1"), ("c", "1")]
    upsert.compact_upsert(spark, folder, ("id",))
    assert read() == [("a", "0"), ("b", "1"), ("c", "1")]
    write(2, [("b", None, 2)])                   # a row without value deletes
    assert read() == [("a", "0"), ("c", "1")]
    write(3, [("a", None, 3), ("c", None, 3)])
    upsert.compact_upsert(spark, folder, ("id",))
    assert read() == []


def test_upsert_records_for_a_compacted_topic(spark):
    df = frame(spark, [("a", "x", 1), ("b", None, 2)])
    got = rows(upsert.upsert_records(df, ("id",), F.col("v").isNull()))
    assert got == [('{"id":"a"}', '{"id":"a","v":"x","n":1}'), ('{"id":"b"}', None)]


def test_compacted_topic_gets_one_record_per_key(spark, folder):
    df = frame(spark, [("a", "z", 1), ("a", "b", 2), ("b", "x", 1)]).repartition(3)
    upsert.upsert_topic(df, None, ("id",), ("n",), kafka={"path": f"{folder}/topic"}, kafka_format="parquet")
    assert rows(spark.read.parquet(f"{folder}/topic")) == [
        ('{"id":"a"}', '{"id":"a","v":"b","n":2}'), ('{"id":"b"}', '{"id":"b","v":"x","n":1}')]


def test_dimension_created_once_and_retry_counts_once(spark, folder):
    config = {"sink_table": "dim_t", "sink_columns": "id,a", "sink_pk": None, "sink_extend": "SALT"}
    shape = dimension.ensure_dimension_table(spark, folder, config)
    dimension.ensure_dimension_table(spark, folder, config)
    assert shape["id"].metadata["sink_extend"] == "SALT"
    assert rows(dimension.read_dimension(spark, folder, "dim_t", shape)) == []

    def log(batch_id, data):
        routed = spark.createDataFrame([("dim_t", "id", d, s) for d, s in data],
                                       "sink_table string, sink_pk string, data map<string,string>, seq bigint")
        dimension.upsert_dimension(routed, folder, batch_id, ("seq",))

    def read():
        return rows(dimension.read_dimension(spark, folder, "dim_t", shape))

    log(0, [({"id": "1", "a": "x"}, 1), ({"id": "2", "a": "y"}, 9)])
    log(1, [({"id": "1", "a": "bad"}, 1)])
    log(1, [({"id": "1", "a": "z"}, 1), ({"id": "2"}, 1)])
    assert read() == [("1", "z"), ("2", "y")]
    dimension.compact_dimension(spark, folder, "dim_t", shape)
    log(2, [({"id": "2", "a": ""}, 0)])
    assert read() == [("1", "z"), ("2", None)]


def test_lookup_reads_only_the_buckets_of_its_keys(spark, folder):
    shape = dimension.ensure_dimension_table(
        spark, folder, {"sink_table": "dim_t", "sink_columns": "id,a,key", "sink_pk": None, "sink_extend": None})

    def log(batch_id, ids, value):
        routed = spark.createDataFrame([("dim_t", "id", {"id": str(i), "a": f"{value}{i}"}, 1) for i in ids],
                                       "sink_table string, sink_pk string, data map<string,string>, seq bigint")
        dimension.upsert_dimension(routed, folder, batch_id, ("seq",))

    def wanted(*ids):
        return lookup.keys_of(spark.createDataFrame([(i,) for i in ids], "k string"), "k")

    def read(keys=None):
        return sorted(r["a"] for r in dimension.read_dimension(spark, folder, "dim_t", shape, keys).collect())

    log(0, range(400), "old")
    dimension.compact_dimension(spark, folder, "dim_t", shape, bucket_rows=20)
    log(1, range(7), "new")
    assert len(read()) == 400
    assert read(wanted("3", "300", "900", None, "3")) == ["new3", "old300"] and read(wanted()) == []
    dimension.compact_dimension(spark, folder, "dim_t", shape, bucket_rows=20)

    # The buckets of other keys may be unreadable.
    files = list(Path(f"{folder}/base/dim_t/upto=1").rglob("*.parquet"))
    needed = {int(p.parent.name.split("=")[1]) for p in files
              if {"3", "300"} & {r["id"] for r in spark.read.parquet(str(p)).collect()}}
    assert len({p.parent for p in files}) > 10 and len(needed) <= 2
    for path in files:
        if int(path.parent.name.split("=")[1]) not in needed:
            path.write_bytes(b"not parquet")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    assert read(wanted("3", "300")) == ["new3", "old300"]

    # Through the lookups, a missing key and a null among them.
    def dim(keys):
        return dimension.read_dimension(spark, folder, "dim_t", shape, keys)

    facts = spark.createDataFrame([("3", 1), ("300", 2), (None, 3)], "k string, n int")
    got = lookup.lookup_dim(facts, dim, "k", {"name": "a"}).collect()
    assert sorted((r["n"], r["name"]) for r in got) == [(1, "new3"), (2, "old300"), (3, None)]
    chained = lookup.lookup_chain(facts, [(dim, "k", {"again": "id"}), (dim, "again", {"name": "a"})]).collect()
    assert sorted((r["n"], r["again"], r["name"]) for r in chained) == [(1, "3", "new3"), (2, "300", "old300"), (3, None, None)]


def test_lookup_table_gets_a_short_list_of_keys(spark, folder):
    spark.range(3000).selectExpr("cast(id as string) dic_code", "concat('n', id) dic_name").write.parquet(f"{folder}/base_dic")
    facts = spark.createDataFrame([("7",), ("7",), (None,), ("none",)], "code string")

    def dictionary(keys):
        return tables.read_lookup_table(spark, "base_dic", root=folder, keys=keys, by="dic_code")

    assert [tuple(r) for r in lookup.lookup_as_of_now(facts, dictionary, "code", "name").collect()] == [("7", "n7")] * 2
    assert dictionary(lookup.keys_of(facts, "code")).count() == 1
    many = spark.range(2000).selectExpr("cast(id as string) code")
    assert lookup.lookup_as_of_now(many, dictionary, "code", "name").count() == 2000


def test_rows_without_key_are_spread(spark):
    facts = spark.range(20_000).selectExpr("cast(null as string) k", "id")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup.lookup_dim(facts, dim, "k", {"n": "name"}).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) < 8_000


def test_summary_columns_in_sink_order_without_transient(spark, folder):
    values = {f.name: F.lit("x") for f in schemas.USER_SPU_SUMMARY.fields}
    values.update(order_count=F.lit(1), order_amount=F.lit(2.0), ts=F.lit(3))
    df = spark.range(1).select(*(values[n].alias(n) for n in sorted(values)))
    summary.write_summary(df, schemas.USER_SPU_SUMMARY, folder)
    stored = summary.read_summary(spark, folder)
    assert stored.columns == [n for n in schemas.USER_SPU_SUMMARY.names if n != "sku_id"]
    assert "sku_id" not in summary.drop_transient(df, schemas.USER_SPU_SUMMARY).columns


def test_topic_null_becomes_empty_and_exactly_once_needs_files(spark, folder):
    df = spark.createDataFrame([("a",), (None,)], "value string")
    topics.write_text_topic(df, "t", fmt="text", root=folder)
    assert rows(read_text_stream(spark, "t", fmt="text", root=folder, streaming=False)) == [("",), ("a",)]
    with pytest.raises(ValueError):
        topics.write_text_topic(df, "t", fmt="kafka", exactly_once=True)


def test_stream_between_topics_and_exactly_once_folders(streams, folder):
    """The pass-through program: all columns of a JSON topic, unchanged, into another."""
    shape = schemas.text_struct("id_a", "id_b", "name_a", "name_b")
    source = streams.createDataFrame([("1", "1", "a", "b"), ("2", None, "aa", None)], shape)
    topics.write_json_topic(source, "test_result", fmt="text", root=folder)
    stream = read_json_stream(streams, "test_result", shape, fmt="text", root=folder)
    for name, once in (("plain", False), ("once", True)):
        topics.write_json_topic(stream.select("*"), name, fmt="text", root=folder, exactly_once=once,
                                checkpoint=f"{folder}/cp-{name}", trigger={"availableNow": True}).awaitTermination()
        read = streams.read.text(f"{folder}/{name}").select("value")
        assert read.count() == 2
    back = read_json_stream(streams, "plain", shape, fmt="text", root=folder, streaming=False)
    assert rows(back) == rows(source)


def test_taps_see_the_rows_of_the_sink(streams, folder):
    streams.range(7).write.parquet(f"{folder}/in")
    stream = taps.tap(streams.readStream.schema("id bigint").parquet(f"{folder}/in"), "passed")
    query = (stream.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    assert query.recentProgress[0]["observedMetrics"]["passed"]["rows"] == 7
    shown = taps.tap_rows(stream, "shown", fmt="memory")
    shown.awaitTermination()
    assert streams.sql("select count(*) from shown").first()[0] == 7


def test_numbered_asks_only_about_wanted_folders(spark, folder, monkeypatch):
    from tideline.sinks import files

    for n in range(12):
        os.makedirs(f"{folder}/batch_id={n}")
        if n != 10:
            open(f"{folder}/batch_id={n}/_SUCCESS", "w").close()
    asked = []
    exists = files.path_exists
    monkeypatch.setattr(files, "path_exists", lambda s, path: asked.append(path) or exists(s, path))
    assert files.numbered(spark, folder, "batch_id", above=8) == [9, 11]
    assert len(asked) == 4
    assert files.numbered(spark, folder, "batch_id", above=3, upto=5) == [4, 5]
    assert len(files.numbered(spark, folder, "batch_id")) == 11


def test_text_topics_are_compressed(spark, folder):
    df = spark.createDataFrame([("x" * 10_000,), (None,), ("é",)], "value string")
    topics.write_text_topic(df.coalesce(1), "t", fmt="text", root=folder)
    (file,) = glob.glob(f"{folder}/t/part-*")
    assert os.path.getsize(file) < 1_000
    assert sorted(r[0] for r in read_text_stream(spark, "t", "text", folder, streaming=False).collect()) == [
        "", "x" * 10_000, "é"]


def test_a_table_of_one_batch_is_read_as_it_is(spark, folder):
    """A batch holds a key once, so its rows are not dealt out again; two batches are."""
    def plan():
        return upsert.read_upsert(spark, folder, ("id",))._jdf.queryExecution().executedPlan().toString()
    df = spark.createDataFrame([("a", 1, False), ("a", 2, False), ("b", 1, True), (None, 1, False)], "id string, n int, gone boolean")
    upsert.upsert_batch(df, folder, ("id",), ("n",), 0, F.col("gone"))
    rows = lambda: sorted(((r.id, r.n) for r in upsert.read_upsert(spark, folder, ("id",)).collect()), key=str)
    assert "Exchange" not in plan()
    assert rows() == [("a", 2), (None, 1)]
    upsert.upsert_batch(df.where("id = 'a'").withColumn("n", F.lit(0)), folder, ("id",), ("n",), 1)
    assert "Exchange" in plan()
    assert rows() == [("a", 0), (None, 1)]
