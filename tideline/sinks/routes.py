"""The routing table in force, folded out of its change topic batch by batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators.cdc import config_images, in_force, newest_images
from tideline.schemas import ROUTE_IMAGE
from tideline.sinks.files import newest
from tideline.streaming.run import start_query


def fold_routes(envelopes, root, batch_id):
    """Write the last image per source table, over the snapshot before this batch and the batch.

    A deleted route stays as an image without ``after``, so an older change that comes late
    does not bring it back. Batches without changes write nothing; a retried batch writes
    its own snapshot again.
    """
    if envelopes.isEmpty():
        return
    spark, images = envelopes.sparkSession, config_images(envelopes)
    before = newest(spark, f"{root}/routes", "batch_id", below=batch_id)
    if before is not None:
        images = images.unionByName(_snapshot(spark, root, before))
    newest_images(images).write.mode("overwrite").parquet(f"{root}/routes/batch_id={batch_id}")


def _snapshot(spark, root, number):
    return spark.read.schema(ROUTE_IMAGE).parquet(f"{root}/routes/batch_id={number}")


def read_routes(spark, root):
    """The routing rows in force at the newest snapshot."""
    number = newest(spark, f"{root}/routes", "batch_id")
    images = spark.createDataFrame([], ROUTE_IMAGE) if number is None else _snapshot(spark, root, number)
    return in_force(images)


def refresh_routes(envelopes, root, checkpoint):
    """Fold the changes not seen so far, and return the routing rows then in force.

    ``envelopes`` is the stream of the change topic; how far it has been read is in its own
    checkpoint. So a call reads new changes and the snapshot, however long the history is.
    """
    start_query(envelopes, checkpoint, each_batch=lambda batch, n: fold_routes(batch, root, n),
                trigger={"availableNow": True}).awaitTermination()
    return read_routes(envelopes.sparkSession, root)
