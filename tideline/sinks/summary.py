"""Summary tables, written by column order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.streaming.run import kept, start_query


def drop_transient(df, schema=None):
    """Leave out the columns that the schema marks as not stored."""
    fields = (schema or df.schema).fields
    return df.drop(*(f.name for f in fields if f.metadata.get("transient")))


def sink_columns(df, schema):
    """The stored columns in sink order and type."""
    stored = [f for f in schema.fields if not f.metadata.get("transient")]
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in stored))


def write_summary(df, schema, path=None, jdbc=None, checkpoint=None, trigger=None,
                  enrich=None):
    """Append summary rows to files, or to the JDBC table in ``jdbc``.

    ``enrich`` is applied to each micro-batch first; tables it reads are therefore
    looked up as they are at that time.

    On files a micro-batch owns one folder and a retry overwrites it. A JDBC table gets
    a retried batch twice, as a plain insert does.
    """
    def each_batch(batch, batch_id):
        if enrich:
            with kept(batch) as rows:
                write(enrich(rows), batch_id)
        else:
            write(batch, batch_id)

    def write(rows, batch_id):
        rows = sink_columns(rows, schema)
        if jdbc:
            rows.write.format("jdbc").options(**jdbc).mode("append").save()
        else:
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    if df.isStreaming:
        return start_query(df, checkpoint, each_batch=each_batch, trigger=trigger)
    each_batch(df, 0)


def read_summary(spark, path):
    return spark.read.parquet(path).drop("batch_id")
