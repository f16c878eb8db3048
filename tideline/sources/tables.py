"""Lookup tables and queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions.scalars import camel_case_name


# Up to as many keys are sent to the source as a list; beyond them the table is read whole.
KEY_LIST = 1000


def read_lookup_table(spark, name, fmt="parquet", root=None, options=None, keys=None, by=None):
    """A lookup table as it is now; jobs read it again in each micro-batch.

    With ``keys``, a frame of wanted ``key`` values, rows whose column ``by`` is another may
    be missing: a short list of keys becomes a condition that the database or file scan
    applies.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    rows = reader.option("dbtable", name).load() if fmt == "jdbc" else reader.load(f"{root}/{name}")
    if keys is None:
        return rows
    listed = [r["key"] for r in keys.limit(KEY_LIST + 1).collect()]
    return rows if len(listed) > KEY_LIST else rows.where(F.col(by).isin(listed))


def read_query(spark, sql, camel=False, options=None):
    """Result of a query, run by the JDBC database in ``options`` or else by Spark.

    With ``camel`` the column names change from ``tm_name`` to ``tmName``.
    """
    if options:
        df = spark.read.format("jdbc").options(**options).option("query", sql).load()
    else:
        df = spark.sql(sql)
    return df.toDF(*(camel_case_name(c) for c in df.columns)) if camel else df
