"""Casts, map, list and set helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

# Money is summed as a decimal so the result does not depend on row order.
MONEY = "decimal(20,6)"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def map_get(data, key):
    """``data['key']``, null when the key is absent."""
    return F.try_element_at(_col(data), F.lit(key))


def json_path(document, *path):
    """Nested field of a parsed object, e.g. ``json_path('common', 'mid')``."""
    field = _col(document)
    for step in path:
        field = field.getField(step)
    return field


def number_of(text, type_name="double"):
    """Text to a number; null when it does not parse."""
    return _col(text).try_cast(type_name)


def csv_contains(csv, item):
    """Whether ``item`` is one of the entries of a comma list."""
    return F.array_contains(F.split(_col(csv), ","), _col(item))


def upper_name(name):
    return F.upper(_col(name))


def set_union(a, b):
    return F.array_union(_col(a), _col(b))


def set_size(values):
    """Number of different members; a null member counts as one."""
    return F.size(F.array_distinct(_col(values)))


def camel_case_name(name):
    """``tm_name`` -> ``tmName``, on a column name and not on rows."""
    head, *tail = name.lower().split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in tail)
