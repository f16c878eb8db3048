"""Looking at rows on their way, without changing them."""

from __future__ import annotations

from pyspark.sql import functions as F


def tap(df, label):
    """Count the rows that pass; the count shows as observed metric ``label``."""
    return df.observe(label, F.count(F.lit(1)).alias("rows"))


def tap_rows(df, label, fmt="console", trigger=None):
    """A second query that shows the rows of a stream."""
    writer = df.writeStream.format(fmt).queryName(label).outputMode("append")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
