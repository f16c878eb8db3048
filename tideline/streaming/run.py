"""Starting queries and restarting them from their checkpoint."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException


def start_query(df, checkpoint, each_batch=None, fmt=None, path=None, options=None,
                trigger=None, name=None):
    """Start an append query into ``each_batch(batch_df, batch_id)`` or a file or topic format."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if each_batch is not None:
        writer = writer.foreachBatch(each_batch)
    else:
        writer = writer.format(fmt).options(**(options or {}))
        if path:
            writer = writer.option("path", path)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


@contextmanager
def kept(batch):
    """A micro-batch stored while several jobs read it, so that it is computed once."""
    rows = batch.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def run_with_restarts(start, restarts=3, wait_seconds=5.0):
    """Run the query that ``start()`` begins to its end, restarting it after a failure.

    The restarted query resumes from its checkpoint. After ``restarts`` failures the
    error is raised.
    """
    for attempt in range(restarts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if attempt == restarts:
                raise
            time.sleep(wait_seconds)
