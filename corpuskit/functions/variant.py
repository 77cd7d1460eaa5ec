"""Typed views of VARIANT values.

Casts on VARIANT are lenient (``"1"`` casts to 1.0, ``true`` to ``"true"``), while
the record model is Python-like (``1 != "1"``). Every typed test therefore checks
the stored type first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def vtype(x: Column) -> Column:
    return F.schema_of_variant(x)


def is_string(x: Column) -> Column:
    return F.coalesce(vtype(x) == "STRING", F.lit(False))


def is_boolean(x: Column) -> Column:
    return F.coalesce(vtype(x) == "BOOLEAN", F.lit(False))


def is_number(x: Column) -> Column:
    t = vtype(x)
    return F.coalesce(t.isin(*_INTEGRAL, "DOUBLE", "FLOAT") | t.startswith("DECIMAL"),
                      F.lit(False))


def is_object(x: Column) -> Column:
    return F.try_variant_get(x, "$", "map<string,variant>").isNotNull()


def as_array(x: Column) -> Column:
    """The elements of an array value, NULL for anything else."""
    return F.try_variant_get(x, "$", "array<variant>")


def vstr(x: Column) -> Column:
    """Text of a scalar (numbers print as numbers); NULL for null/object."""
    return F.try_variant_get(x, "$", "string")


def vdouble(x: Column) -> Column:
    return F.try_variant_get(x, "$", "double")


def vbool(x: Column) -> Column:
    return F.try_variant_get(x, "$", "boolean")


def as_python_value(x: Column) -> Column:
    """NULL for JSON null, objects and SQL NULL; the value otherwise."""
    return F.when(F.is_variant_null(x) | is_object(x), F.lit(None)).otherwise(x)


def key_path(key: str) -> str:
    """JSONPath for one object key; keys may contain dots, colons, quotes."""
    if "'" not in key:
        return "$['" + key + "']"
    if '"' not in key:
        return '$["' + key + '"]'
    raise ValueError(f"key with both quote kinds is not addressable: {key!r}")


def get_key(x: Column, key: str) -> Column:
    return F.try_variant_get(x, key_path(key), "variant")


def literal_variant(value) -> Column:
    """A constant VARIANT (folded once by the optimizer)."""
    import json

    return F.parse_json(F.lit(json.dumps(value)))


def equals_value(x: Column, value) -> Column:
    """Python ``x == value`` for a scalar variant ``x``; never NULL."""
    if value is None:
        return F.coalesce(x.isNull() | F.is_variant_null(x), F.lit(True))
    if isinstance(value, bool):
        return F.coalesce(is_boolean(x) & (vbool(x) == F.lit(value)), F.lit(False))
    if isinstance(value, (int, float)):
        return F.coalesce((is_number(x) | is_boolean(x)) & (vdouble(x) == F.lit(float(value))),
                          F.lit(False))
    return F.coalesce(is_string(x) & (vstr(x) == F.lit(str(value))), F.lit(False))


def in_values(x: Column, values) -> Column:
    """Python ``x in values`` for a scalar variant; never NULL."""
    values = list(values)
    strings = [v for v in values if isinstance(v, str)]
    others = [v for v in values if not isinstance(v, str)]
    cond = F.lit(False)
    if strings:
        cond = cond | F.coalesce(is_string(x) & vstr(x).isin(*strings), F.lit(False))
    for v in others:
        cond = cond | equals_value(x, v)
    return cond
