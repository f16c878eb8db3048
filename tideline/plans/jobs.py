"""The twelve jobs on topics and tables: what to read, which plan to run, where to write.

Each function starts one streaming query (two where a side output is written) and
returns it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession

from tideline import schemas
from tideline.functions.time import processing_time
from tideline.operators.parse import parse_page_log
from tideline.operators.windows import with_bounds
from tideline.plans import traffic, trade
from tideline.plans.dimensions import route_batch
from tideline.sinks.dimension import read_dimension
from tideline.sinks.files import path_exists
from tideline.sinks.routes import refresh_routes
from tideline.sinks.summary import write_summary
from tideline.sinks.topics import write_text_topic
from tideline.sinks.upsert import create_upsert, stream_upserts, upsert_topic
from tideline.sources.tables import read_lookup_table
from tideline.sources.topics import read_changelog, read_config_changes, read_text_stream
from tideline.streaming.run import kept, start_query


@dataclass
class Warehouse:
    """Where the jobs find their topics, tables and checkpoints."""

    spark: SparkSession
    root: str
    checkpoints: str
    fmt: str = "text"
    database: str | None = None
    options: dict = field(default_factory=dict)
    # Upserts as compacted Kafka topics: writer options without the topic; else tables of files.
    upsert_topics: dict | None = None
    # JDBC reader options of the dictionary and writer options of the summaries; else files.
    lookup_jdbc: dict | None = None
    summary_jdbc: dict | None = None
    # Idle days after which the state of a device or user is freed; None keeps it.
    ttl_days: int | None = 1
    # Micro-batches between two compactions of a table's change log.
    compact_every: int = 500
    # How often a failed query is started again.
    restarts: int = 3
    trigger: dict = field(default_factory=lambda: {"processingTime": "1 second"})

    @property
    def topics(self):
        return f"{self.root}/topics"

    def prepare(self):
        """Create the folders of file topics and tables, so jobs may start in any order."""
        if self.fmt != "kafka":
            empty = self.spark.createDataFrame([], "value string")
            for topic in (schemas.TOPIC_LOG, schemas.TOPIC_DB, schemas.TOPIC_PAGE_VIEW,
                          schemas.TOPIC_UNIQUE_VISITOR, schemas.TOPIC_USER_JUMP, schemas.TABLE_PROCESS_TOPIC):
                if not path_exists(self.spark, f"{self.topics}/{topic}"):
                    empty.write.format(self.fmt).save(f"{self.topics}/{topic}")
        for topic, columns in ((schemas.TOPIC_ORDER_DETAIL, schemas.ORDER_DETAIL_COLUMNS),
                               (schemas.TOPIC_PAY_DETAIL, schemas.PAY_DETAIL_COLUMNS)):
            path = f"{self.root}/tables/{topic}"
            if not path_exists(self.spark, path):
                create_upsert(self.spark, path, self.shape(columns))
        return self

    @staticmethod
    def shape(columns):
        return (schemas.text_struct(*columns).add(schemas.ROW_TIME, "timestamp")
                .add(schemas.VERSION, schemas.VERSION_TYPE))

    def text(self, topic):
        return read_text_stream(self.spark, topic, fmt=self.fmt, root=self.topics, options=self.options)

    def pages(self):
        return parse_page_log(self.text(schemas.TOPIC_PAGE_VIEW))

    def changes(self):
        return read_changelog(self.spark, schemas.TOPIC_DB, fmt=self.fmt, root=self.topics,
                              options=self.options)

    def publish(self, df, topic):
        return write_text_topic(df, topic, fmt=self.fmt, root=self.topics, options=self.options,
                                checkpoint=f"{self.checkpoints}/{topic}", trigger=self.trigger)

    def upsert(self, df, topic, key, enrich):
        kafka = None if self.upsert_topics is None else {**self.upsert_topics, "topic": topic}
        return upsert_topic(df, f"{self.root}/tables/{topic}", (key,), (schemas.VERSION,),
                            checkpoint=f"{self.checkpoints}/{topic}", trigger=self.trigger, enrich=enrich,
                            kafka=kafka, compact_every=self.compact_every)

    def summarise(self, df, schema, name, enrich=None):
        jdbc = None if self.summary_jdbc is None else {**self.summary_jdbc, "dbtable": name}
        return write_summary(df, schema, f"{self.root}/summaries/{name}", jdbc,
                             checkpoint=f"{self.checkpoints}/{name}", trigger=self.trigger, enrich=enrich)

    def upserts(self, topic, columns):
        return stream_upserts(self.spark, f"{self.root}/tables/{topic}", self.shape(columns))

    def dictionary(self, keys=None):
        wanted = {"keys": keys, "by": "dic_code"}
        if self.lookup_jdbc is not None:
            return read_lookup_table(self.spark, "base_dic", "jdbc", options=self.lookup_jdbc, **wanted)
        return read_lookup_table(self.spark, "base_dic", root=f"{self.root}/lookup", **wanted)

    def dimension(self, name, columns, keys=None):
        """Current rows of ``dim_<name>``, or of its ``keys``."""
        return read_dimension(self.spark, f"{self.root}/dims", f"dim_{name}", schemas.dimension_schema(columns), keys)

    def lookup(self, name, columns):
        """``dim_<name>`` as a function of the wanted keys."""
        return partial(self.dimension, name, columns)


def run_job(job, w, **options):
    """Run a job to the end of its queries; after a failure stop them and start it again.

    Each query resumes from its checkpoint. After ``w.restarts`` failures the error is raised.
    """
    for attempt in range(w.restarts + 1):
        started = job(w, **options)
        queries = started if isinstance(started, tuple) else (started,)
        try:
            # In turn, so that the failure of any is seen while others go on.
            waiting = list(queries)
            while waiting:
                waiting = [query for query in waiting if not query.awaitTermination(1)]
            return
        except StreamingQueryException:
            for query in queries:
                query.stop()
            if attempt == w.restarts:
                raise


def dim_job(w):
    def each_batch(batch, batch_id):
        # The routes are brought up to date first, so one is known before the rows it applies to.
        envelopes = read_config_changes(w.spark, fmt=w.fmt, root=w.topics,
                                        options={**w.options, "startingOffsets": "earliest"})
        config = refresh_routes(envelopes, f"{w.root}/dims", f"{w.checkpoints}/routes")
        route_batch(batch.sparkSession, batch, config, f"{w.root}/dims", batch_id, (schemas.SEQ,), w.compact_every)

    return start_query(w.changes(), f"{w.checkpoints}/dim", each_batch=each_batch, trigger=w.trigger)


def page_view_job(w):
    pages, dirty = traffic.page_view_detail(w.text(schemas.TOPIC_LOG))
    return w.publish(pages, schemas.TOPIC_PAGE_VIEW), w.publish(dirty, "dirty_log")


def unique_visitor_job(w):
    return w.publish(traffic.unique_visitor_detail(w.text(schemas.TOPIC_PAGE_VIEW), w.ttl_days),
                     schemas.TOPIC_UNIQUE_VISITOR)


def bounce_job(w):
    return w.publish(traffic.bounce_detail(w.text(schemas.TOPIC_PAGE_VIEW)), schemas.TOPIC_USER_JUMP)


def visit_summary_job(w):
    visitors = parse_page_log(w.text(schemas.TOPIC_UNIQUE_VISITOR))
    jumps = parse_page_log(w.text(schemas.TOPIC_USER_JUMP))
    return w.summarise(traffic.visit_summary(visitors, jumps, w.pages()), schemas.VISIT_SUMMARY,
                       "traffic_vc_ch_ar_page_view_window")


def home_detail_job(w):
    return w.summarise(traffic.home_detail_summary(w.pages(), ttl_days=w.ttl_days), schemas.HOME_DETAIL_SUMMARY,
                       "traffic_page_view_window")


def login_job(w):
    return w.summarise(traffic.login_summary(w.pages()), schemas.LOGIN_SUMMARY, "user_user_login_window")


def order_detail_job(w, seconds=5):
    def enrich(batch):
        named = trade.name_source_type(batch, w.dictionary, (schemas.VERSION,))
        return named.withColumn(schemas.ROW_TIME, processing_time())

    joined = trade.joined_changes(w.changes(), seconds, database=w.database, keep=(schemas.SEQ,))
    return w.upsert(joined, schemas.TOPIC_ORDER_DETAIL, "id", enrich)


def pay_detail_job(w, seconds=905):
    details = w.upserts(schemas.TOPIC_ORDER_DETAIL, schemas.ORDER_DETAIL_COLUMNS)
    joined = trade.joined_payments(w.changes(), details, seconds, database=w.database, keep=(schemas.SEQ,))
    return w.upsert(joined, schemas.TOPIC_PAY_DETAIL, "order_detail_id",
                    lambda batch: trade.name_payment_type(batch, w.dictionary))


def payer_job(w):
    payments = w.upserts(schemas.TOPIC_PAY_DETAIL, schemas.PAY_DETAIL_COLUMNS)
    return w.summarise(trade.payer_summary(payments, (schemas.VERSION,)), schemas.PAYER_SUMMARY, "trade_payment_suc_window")


def province_job(w):
    details = w.upserts(schemas.TOPIC_ORDER_DETAIL, schemas.ORDER_DETAIL_COLUMNS)

    def enrich(batch):
        return trade.name_provinces(batch, w.lookup("base_province", "id,name"))

    return w.summarise(with_bounds(trade.province_totals(details, (schemas.VERSION,))), schemas.PROVINCE_SUMMARY,
                       "trade_province_order_window", enrich)


# The dimension columns the user and product summary looks up.
SPU_DIMENSIONS = {
    "sku_info": "id,spu_id,tm_id,category3_id",
    "spu_info": "id,spu_name",
    "base_trademark": "id,tm_name",
    "base_category3": "id,name,category2_id",
    "base_category2": "id,name,category1_id",
    "base_category1": "id,name",
}


def user_spu_job(w):
    """Two queries: sku columns are group keys, so they are attached and logged first."""
    details = w.upserts(schemas.TOPIC_ORDER_DETAIL, schemas.ORDER_DETAIL_COLUMNS)
    path = f"{w.root}/tables/order_detail_sku"
    shape = w.shape(("id", "order_id", "user_id", "sku_id", "create_time", "split_total_amount",
                     "spu_id", "trademark_id", "category3_id"))

    def log_sku(batch, batch_id):
        with kept(batch) as rows:
            named = trade.attach_sku(rows, w.lookup("sku_info", SPU_DIMENSIONS["sku_info"]))
            named.select(*shape.names).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    def enrich(batch):
        return trade.name_user_spu(batch, {n: w.lookup(n, c) for n, c in SPU_DIMENSIONS.items()})

    w.spark.createDataFrame([], shape).write.mode("overwrite").parquet(f"{path}/batch_id=-1")
    logged = start_query(details, f"{w.checkpoints}/order_detail_sku", each_batch=log_sku, trigger=w.trigger)
    if "availableNow" in w.trigger:
        logged.awaitTermination()
    rows = trade.user_spu_first(w.spark.readStream.schema(shape).parquet(path), (schemas.ROW_TIME, schemas.VERSION))
    summary = w.summarise(with_bounds(trade.user_spu_totals(rows)), schemas.USER_SPU_SUMMARY,
                          "trade_user_spu_order_window", enrich)
    return logged, summary
