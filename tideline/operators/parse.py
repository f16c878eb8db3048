"""JSON text to rows and back."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tideline.functions.scalars import number_of
from tideline.schemas import PAGE_LOG_TEXT

_BAD = "_bad_record"
# Keys of a page log that mark other kinds of rows, and lists that are not kept.
_NOT_PAGE = ("err", "start")
_DROPPED = ("err", "displays", "actions")


def _kept(parsed, condition):
    """The parsed value as zero or one row.

    A plain filter on it would be pushed below the projection that computes it, and the
    text would then be parsed once for the filter and once more for the result.
    """
    return F.explode(F.filter(F.array(parsed), condition))


def parse_json(df, schema, value="value", keep=()):
    """Rows whose text is a JSON object, as the columns of ``schema``.

    Empty text (a tombstone) and text that is not an object are left out.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    parsed = F.from_json(value, with_bad, {"columnNameOfCorruptRecord": _BAD})
    good = _kept(parsed, lambda p: p.isNotNull() & p[_BAD].isNull())
    return df.select(*keep, good.alias("_parsed")).select(
        *keep, *(F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields))


def split_dirty(df, value="value"):
    """``(good, dirty)``: text that is a JSON object, and all other text."""
    is_object = F.from_json(value, "map<string,variant>").isNotNull()
    return df.where(is_object), df.where(~is_object)


def parse_page_log(df, value="value", keep=()):
    """Page log text as typed ``common``, ``page``, ``ts``, ``err`` and ``start``."""
    rows = parse_json(df, PAGE_LOG_TEXT, value, keep)
    page = F.struct(
        F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"),
        number_of("page.during_time", "bigint").alias("during_time"),
    )
    return rows.withColumn("page", page).withColumn("ts", number_of("ts", "bigint"))


def page_view_text(df, value="value"):
    """Page rows as JSON text, minus error, exposure and action parts.

    Works on the object's keys, so fields nobody declared pass through unchanged.
    """
    def is_page(keys):
        condition = keys.isNotNull()
        for name in _NOT_PAGE:
            entry = F.try_element_at(keys, F.lit(name))
            condition &= entry.isNull() | F.is_variant_null(entry)
        return condition

    rows = df.select(_kept(F.from_json(value, "map<string,variant>"), is_page).alias("_keys"))
    return rows.select(F.to_json(F.map_filter("_keys", lambda k, _: ~k.isin(*_DROPPED))).alias("value"))


def to_json_text(df, columns=None, keep_nulls=True):
    """One ``value`` column holding each row as a JSON object."""
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return df.select(F.to_json(F.struct(*(columns or df.columns)), options).alias("value"))
