"""Topics of text records: Kafka, or folders of text files where no Kafka jar is at hand."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.cdc import change_seq, latest_config
from tideline.operators.parse import parse_json
from tideline.schemas import CHANGE_ORDER, CHANGELOG, SEQ, TABLE_PROCESS, TABLE_PROCESS_TOPIC


def read_text_stream(spark, topic, fmt="kafka", root=None, streaming=True, options=None, position=False):
    """One ``value`` text column; a null record reads as the empty text.

    With ``position`` also ``partition`` and ``offset``, null where the topic has none.

    ``options`` go to the reader, e.g. ``kafka.bootstrap.servers``, ``startingOffsets``
    or ``maxFilesPerTrigger``. Offsets live in the query's checkpoint.
    """
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**(options or {}))
    if fmt == "kafka":
        rows = reader.option("subscribe", topic).load()
    else:
        rows = reader.load(f"{root}/{topic}")
    value = F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value")
    if not position:
        return rows.select(value)
    return rows.select(value, *((F.col(c) if fmt == "kafka" else F.lit(None)).cast("bigint").alias(c)
                                for c in ("partition", "offset")))


def read_json_stream(spark, topic, schema, position=False, **kwargs):
    """Records as the columns of ``schema``; tombstones and bad text are left out."""
    rows = read_text_stream(spark, topic, position=position, **kwargs)
    return parse_json(rows, schema, keep=("partition", "offset") if position else ())


def read_changelog(spark, topic="topic_db", **kwargs):
    """Change-log rows with their order ``seq`` and the processing time ``pt``."""
    rows = read_json_stream(spark, topic, CHANGELOG, position=True, **kwargs)
    return rows.withColumn(SEQ, change_seq()).drop(*CHANGE_ORDER).withColumn("pt", F.current_timestamp())


CONFIG_ENVELOPE = T.StructType([
    T.StructField("before", TABLE_PROCESS),
    T.StructField("after", TABLE_PROCESS),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("seq", T.LongType()),
])


def parse_config(df):
    """Routing rows in force, from change envelopes as text."""
    return latest_config(parse_json(df, CONFIG_ENVELOPE))


def read_config_changes(spark, topic=TABLE_PROCESS_TOPIC, **kwargs):
    """The change envelopes of the routing table as a stream."""
    return parse_json(read_text_stream(spark, topic, **kwargs), CONFIG_ENVELOPE)


def read_config_stream(spark, topic="table_process", **kwargs):
    """The routing table as it is now.

    A batch read of the whole topic, for one look at it; jobs follow it with
    ``refresh_routes``.
    """
    return parse_config(read_text_stream(spark, topic, streaming=False, **kwargs))
