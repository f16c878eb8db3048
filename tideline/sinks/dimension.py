"""Dimension tables: a shared change log, routed by configuration, and compacted bases."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.cdc import dimension_changes, latest_dimension
from tideline.schemas import SEQ_TYPE, dimension_schema
from tideline.sinks.files import newest, newest_part, numbered

_NONE_YET = -1
# Rows a bucket of a base should hold; a lookup of few keys reads few buckets.
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 4096


def ensure_dimension_table(spark, root, config_row):
    """Create the sink table of a configuration row, empty, when it is not there."""
    schema = dimension_schema(config_row["sink_columns"], config_row["sink_pk"], config_row["sink_extend"])
    path = f"{root}/base/{config_row['sink_table']}"
    if newest(spark, path, "upto") is None:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/upto={_NONE_YET}")
    return schema


def upsert_dimension(routed, root, batch_id, order):
    """Log one batch of routed changes, one folder per sink table, in a single job.

    A retry of the batch overwrites the batch's own folder.
    """
    (dimension_changes(routed, order).write.mode("overwrite").partitionBy("sink_table")
     .parquet(f"{root}/log/batch_id={batch_id}"))


LOG = (T.StructType().add("sink_table", "string").add("pk", "string")
       .add("data", T.MapType(T.StringType(), T.StringType())).add("seq", SEQ_TYPE).add("batch_id", "long"))


def _changes(spark, root, sink_table, after, upto=None):
    """Logged rows of batches after ``after``: only their folders are listed and read."""
    batches = numbered(spark, f"{root}/log", "batch_id", above=after, upto=upto)
    if not batches:
        return None
    log = (spark.read.schema(LOG).option("basePath", f"{root}/log")
           .parquet(*(f"{root}/log/batch_id={n}" for n in batches)))
    mine = log.where(F.col("sink_table") == sink_table)
    return mine.withColumn("seq", F.concat(F.array("batch_id"), "seq"))


def _key_name(schema):
    return next(f.name for f in schema.fields if f.metadata.get("primary_key"))


def _bucket(key, buckets):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _newest_base(spark, root, sink_table, schema, keys=None):
    """The newest base and the batch it covers; with ``keys`` only the buckets these are in."""
    path = f"{root}/base/{sink_table}"
    upto = newest(spark, path, "upto")
    buckets = newest_part(spark, f"{path}/upto={upto}", "of")
    if buckets is None:
        return spark.read.schema(schema).parquet(f"{path}/upto={upto}"), upto
    shape = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    base = spark.read.schema(shape).parquet(f"{path}/upto={upto}/of={buckets}")
    if keys is not None and buckets > 1:
        # At most one number for each bucket.
        wanted = [r[0] for r in keys.select(_bucket(F.col("key"), buckets)).distinct().collect()]
        base = base.where(F.col("bucket").isin(wanted))
    return base.drop("bucket"), upto


def read_dimension(spark, root, sink_table, schema, keys=None):
    """The current rows of a sink table, one per key.

    ``keys``, a frame with the one column ``key`` (text, no nulls, no repeats), leaves other
    rows out before the newest are chosen, and their buckets of the base unread.
    """
    base, upto = _newest_base(spark, root, sink_table, schema, keys)
    changes = _changes(spark, root, sink_table, upto)
    if keys is not None:
        wanted = keys.select(F.col("key").alias("_wanted"))
        base = base.join(wanted, F.col(_key_name(schema)) == F.col("_wanted"), "left_semi")
        changes = changes if changes is None else changes.join(wanted, F.col("pk") == F.col("_wanted"), "left_semi")
    return base if changes is None else latest_dimension(changes, schema, base)


def compact_dimension(spark, root, sink_table, schema, bucket_rows=BUCKET_ROWS):
    """Write the current rows as a new base covering every batch logged so far.

    The base is cut into buckets by a hash of the key, about one for ``bucket_rows`` rows.
    """
    last = newest(spark, f"{root}/log", "batch_id")
    base, before = _newest_base(spark, root, sink_table, schema)
    if last is None or last <= before:
        return
    changes = _changes(spark, root, sink_table, before, last)
    # Counts of files and their footers; a key changed twice is counted twice.
    buckets = min(MAX_BUCKETS, -(-(base.count() + changes.count()) // bucket_rows) or 1)
    key = F.col(_key_name(schema))
    rows = latest_dimension(changes, schema, base).withColumn("bucket", _bucket(key, buckets))
    # By ranges, so that each task writes few buckets and a large one is shared by several tasks.
    rows = rows.repartitionByRange("bucket", key).withColumn("of", F.lit(buckets))
    rows.write.mode("overwrite").partitionBy("of", "bucket").parquet(f"{root}/base/{sink_table}/upto={last}")
