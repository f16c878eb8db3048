"""Change-log views, configuration routing and latest dimension rows."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import map_get
from tideline.schemas import CHANGE_ORDER, CHANGE_TYPES, PAYMENT_CDC, PAYMENT_SUCCESS


def change_seq():
    """The order of a change as one comparable value."""
    return F.array(*(F.col(c).cast("bigint") for c in CHANGE_ORDER))


def filter_change_types(df, types=CHANGE_TYPES):
    return df.where(F.col("type").isin(*types))


def cdc_view(df, table, columns, database=None, change_type="insert", keep=()):
    """Rows of one source table as text columns taken from the ``data`` map."""
    rows = df.where((F.col("table") == table) & (F.col("type") == change_type))
    if database is not None:
        rows = rows.where(F.col("database") == database)
    return rows.select(*(map_get("data", c).alias(c) for c in columns), *keep)


def payment_success_view(df, database=None, keep=()):
    """Payment rows updated to success."""
    paid = df.where(map_get("data", "payment_status") == PAYMENT_SUCCESS)
    return cdc_view(paid, "payment_info", PAYMENT_CDC, database, "update", keep)


def config_images(envelopes):
    """The source table of each envelope, its image ``after`` the change, and its order."""
    source = F.coalesce("after.source_table", "before.source_table").alias("source_table")
    return envelopes.select(source, "after", "ts_ms", "seq")


def newest_images(images):
    """The last image per source table, deletes included."""
    last = images.groupBy("source_table").agg(
        F.max_by(F.struct("after", "ts_ms", "seq"), F.struct("ts_ms", "seq")).alias("_last"))
    return last.select("source_table", "_last.*")


def in_force(images):
    return images.where(F.col("after").isNotNull()).select("after.*")


def latest_config(envelopes):
    """Routing rows in force: the last image per source table, deletes removed.

    ``envelopes`` has ``op``, ``ts_ms``, and ``before``/``after`` images.
    """
    return in_force(newest_images(config_images(envelopes)))


def keep_columns(data, sink_columns):
    """Map entries whose key is in the comma list."""
    wanted = F.split(sink_columns, ",")
    return F.map_filter(data, lambda k, _: F.array_contains(wanted, k))


def tag_sink(df, data="data", sink_columns="sink_columns"):
    """Prune the ``data`` map to the configured columns of the row's sink table."""
    return df.withColumn(data, keep_columns(F.col(data), F.col(sink_columns)))


def route_by_config(changes, config):
    """Changes of configured tables with sink table, key and pruned data.

    The configuration is one row per source table, so its side of the join is small
    and Spark broadcasts it once it has checked the size.
    """
    routes = config.select(
        F.col("source_table").alias("_source"), "sink_table", "sink_columns",
        F.coalesce(F.nullif(F.col("sink_pk"), F.lit("")), F.lit("id")).alias("sink_pk"))
    routed = changes.join(routes, F.col("table") == F.col("_source"), "inner").drop("_source")
    return tag_sink(routed)


def dimension_changes(routed, order):
    """``sink_table, pk, data, seq``: what the dimension log stores. Empty text is null.

    The columns of ``order``, numbers or arrays of numbers, become one array.
    """
    def numbers(c):
        is_array = isinstance(routed.schema[c].dataType, T.ArrayType)
        return F.col(c) if is_array else F.array(F.col(c).cast("bigint"))

    blank_to_null = F.transform_values("data", lambda _, v: F.nullif(v, F.lit("")))
    pk = F.try_element_at("data", F.col("sink_pk"))
    return (routed.select("sink_table", pk.alias("pk"), blank_to_null.alias("data"),
                          F.concat(*map(numbers, order)).alias("seq"))
            .where(F.col("pk").isNotNull()))


def latest_dimension(changes, schema, base=None):
    """One row per key; for each column the last change that carried it wins.

    ``changes`` are the logged rows of one sink table, ``base`` an older result that any
    change overrides. Runs as one aggregate with a partial step per task. The value is no
    part of the order, so a later change wins whatever its text, null included.
    """
    def parts_of(df, pk, value, rank, seq, present):
        return df.select(pk.alias("pk"), *(
            part for i, c in enumerate(schema.names) for part in (
                value(c).alias(f"_v{i}"),
                F.when(present(c), F.struct(F.lit(rank).alias("rank"), seq.alias("seq"))).alias(f"_o{i}"))))

    parts = parts_of(changes, F.col("pk"), lambda c: map_get("data", c), 1, F.col("seq"),
                     lambda c: F.map_contains_key("data", c))
    if base is not None:
        pk = next(f.name for f in schema.fields if f.metadata.get("primary_key"))
        no_seq = F.lit(None).cast(changes.schema["seq"].dataType)
        parts = parts.unionByName(parts_of(base, F.col(pk), F.col, 0, no_seq, lambda c: F.lit(True)))
    last = parts.groupBy("pk").agg(*(F.max_by(f"_v{i}", f"_o{i}").alias(c) for i, c in enumerate(schema.names)))
    return last.select(*schema.names)


def order_metric_rows(df, keys, amount="split_total_amount", keep=(), kind="double"):
    """Order detail rows as keys, order id, amount as a number of ``kind`` and creation time."""
    return df.select(*keys, "order_id", F.col(amount).try_cast(kind).alias("order_amount"),
                     "create_time", *keep)
