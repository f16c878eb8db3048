"""Dimension job: route change-log rows into configured dimension tables."""

from __future__ import annotations

from tideline.operators.cdc import filter_change_types, route_by_config
from tideline.schemas import TABLE_PROCESS, dimension_schema
from tideline.sinks.dimension import compact_dimension, ensure_dimension_table, upsert_dimension


def routed_changes(changes, config):
    """Inserts and updates of configured tables, pruned and tagged with their sink table."""
    return route_by_config(filter_change_types(changes), config)


def valid_routes(spark, config):
    """The routing rows in force, the same as a frame, and those no table can be made of.

    The routing table has one row per source table. It is read once per micro-batch, for
    the tables to create and for the join.
    """
    good, bad = [], []
    for row in config.collect():
        try:
            dimension_schema(row["sink_columns"], row["sink_pk"], row["sink_extend"])
            (good if row["sink_table"] else bad).append(row)
        except ValueError:
            bad.append(row)
    return good, spark.createDataFrame(good, TABLE_PROCESS), bad


def route_batch(spark, changes, config, root, batch_id, order, compact_every=None):
    """Create missing sink tables and log one batch of changes; returns the number of bad routes.

    Bad routing rows never stop the job: they are set aside in ``bad_routes``, one folder
    per batch that saw any. With ``compact_every``, every so many batches the logged
    changes are folded into new bases.
    """
    routes, table, bad = valid_routes(spark, config)
    if bad:
        spark.createDataFrame(bad, TABLE_PROCESS).write.mode("overwrite").json(f"{root}/bad_routes/batch_id={batch_id}")
    shapes = {row["sink_table"]: ensure_dimension_table(spark, root, row) for row in routes}
    upsert_dimension(routed_changes(changes, table), root, batch_id, order)
    if compact_every and batch_id and batch_id % compact_every == 0:
        for sink_table, shape in shapes.items():
            compact_dimension(spark, root, sink_table, shape)
    return len(bad)
