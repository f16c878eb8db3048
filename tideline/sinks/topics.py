"""Writers of text and JSON topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.parse import to_json_text
from tideline.streaming.run import start_query


def write_text_topic(df, topic, fmt="kafka", root=None, checkpoint=None, exactly_once=False,
                     options=None, trigger=None):
    """Write the ``value`` column as records of a topic; null becomes the empty text.

    A stream returns its running query. With ``exactly_once`` each micro-batch owns a
    folder that a retry overwrites; a Kafka topic cannot promise that. Text files are
    compressed unless ``options`` name a ``compression``, as the broker does for a topic.
    """
    text = df.select(F.coalesce("value", F.lit("")).alias("value"))
    if exactly_once and fmt == "kafka":
        raise ValueError("Spark writes to Kafka at least once; use a file topic")
    target = dict(options or {})
    if fmt == "kafka":
        target["topic"] = topic
    elif fmt == "text":
        target.setdefault("compression", "gzip")
    path = None if fmt == "kafka" else f"{root}/{topic}"
    if not df.isStreaming:
        writer = text.write.format(fmt).options(**target).mode("append")
        return writer.save(path) if path else writer.save()
    if exactly_once:
        def each_batch(batch, batch_id):
            batch.write.format(fmt).options(**target).mode("overwrite").save(f"{path}/batch_id={batch_id}")
        return start_query(text, checkpoint, each_batch=each_batch, trigger=trigger)
    return start_query(text, checkpoint, fmt=fmt, path=path, options=target, trigger=trigger)


def write_json_topic(df, topic, columns=None, **kwargs):
    """Write rows as JSON records, nulls included."""
    return write_text_topic(to_json_text(df, columns), topic, **kwargs)
