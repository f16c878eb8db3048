"""Dictionary and dimension lookups.

None of these forces a broadcast. Spark broadcasts a side whose size it has checked
against ``spark.sql.autoBroadcastJoinThreshold``, at planning or at run time; beyond
it the join is a shuffle whose skewed partitions adaptive execution splits. The
looked-up tables hold one row per key, as ``latest_dimension`` returns them.

A looked-up table may be given as a function of the wanted keys, a frame with the one
column ``key``. It then reads no more of the table than those keys need; the rows are read
once for their keys and once for the join, so a micro-batch should be stored before.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows without key match nothing, and are spread over as many join keys.
NULL_SPREAD = 1024


def keys_of(df, key):
    """The different values of a column as ``key``, null left out."""
    return df.select(F.col(key).alias("key")).where(F.col("key").isNotNull()).distinct()


def _null_spread(df, key):
    """0 for a row with a key, else a number from 1 that depends on the row."""
    plain = [f"`{f.name}`" for f in df.schema.fields
             if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*(plain or [F.lit(0)])), F.lit(NULL_SPREAD)) + 1).otherwise(0)


def lookup_as_of_now(df, dictionary, code, name, dic_code="dic_code", dic_name="dic_name"):
    """Inner join with the dictionary as it is now; rows without an entry are dropped."""
    if callable(dictionary):
        dictionary = dictionary(keys_of(df, code))
    entries = dictionary.select(F.col(dic_code).alias("_code"), F.col(dic_name).alias(name))
    return df.join(entries, F.col(code) == F.col("_code"), "inner").drop("_code")


def lookup_dim(df, dimension, key, columns, dim_key="id", on_missing="keep", default=None, keys=None):
    """Attach dimension columns, given as ``{new_name: dimension_column}``.

    A row whose key is not found keeps nulls, or ``default``; ``on_missing="drop"``
    leaves it out. ``keys`` are the wanted keys where the caller knows them better than
    by reading ``df``.
    """
    if callable(dimension):
        dimension = dimension(keys_of(df, key) if keys is None else keys)
    if on_missing not in ("keep", "drop"):
        raise ValueError("on_missing is keep or drop")
    picked = dimension.select(F.col(dim_key).alias("_dim_key"),
                              *(F.col(c).alias(n) for n, c in columns.items()))
    if on_missing == "keep":
        spread = df.withColumn("_spread", _null_spread(df, key))
        matched = (F.col(key) == F.col("_dim_key")) & (F.col("_spread") == F.col("_dim_spread"))
        out = spread.join(picked.withColumn("_dim_spread", F.lit(0).cast("bigint")), matched, "left").drop(
            "_spread", "_dim_key", "_dim_spread")
    else:
        out = df.join(picked, F.col(key) == F.col("_dim_key"), "inner").drop("_dim_key")
    if default is not None:
        out = out.withColumns({n: F.coalesce(F.col(n), F.lit(default)) for n in columns})
    return out


def lookup_chain(df, steps, on_missing="keep"):
    """Lookups in turn; a step may use a column that an earlier one attached.

    Each step is ``(dimension, key, columns)`` or ``(dimension, key, columns, dim_key)``.
    The keys of a step that uses a column of an earlier one are taken from what that one
    found, not from the joined rows.
    """
    found, out = {}, df
    for dimension, key, columns, *dim_key in steps:
        if callable(dimension):
            dimension = dimension(keys_of(found.get(key, df), key))
        attached = dimension.select(*(F.col(c).alias(n) for n, c in columns.items()))
        found.update(dict.fromkeys(columns, attached))
        out = lookup_dim(out, dimension, key, columns, *dim_key, on_missing=on_missing)
    return out
