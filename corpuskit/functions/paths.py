"""Path access on schema-less records stored as one VARIANT column.

A path is a sequence of object keys (a dotted string by default). Walking it maps
over lists: ``{"a": [{"b": 1}, {"c": 2}]}`` at ``a.b`` is the list ``[1, None]``.
The result of a walk is a *terminal*: ``struct<is_list BOOLEAN, vals ARRAY<VARIANT>>``.

* ``is_list`` is true as soon as any step met a list (the value is a list per row);
* ``vals`` holds the flattened values; a scalar result is one element. Objects,
  JSON nulls, missing keys and keys applied to non-objects all give NULL in place,
  so list positions survive.

Everything compiles to higher-order functions on VARIANT, evaluated inside the
scan stage; no Python runs per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.repair import Repair, repair_expand
from corpuskit.session import materialize
from corpuskit.functions.variant import as_array, as_python_value, get_key, is_object, is_string, \
    vstr


def split_path(path: str | Sequence[str], sep: str = ".") -> tuple[str, ...]:
    if isinstance(path, str):
        return tuple(path.split(sep)) if path else ()
    return tuple(path)


def _getter(key: str):
    return lambda x: get_key(x, key)


def _expand(c: Column) -> Column:
    return F.coalesce(as_array(c), F.array(c))


def _flat(vals: Column) -> Column:
    """All nested lists dissolved, however deep.

    A list can be nested no deeper than its text has brackets; that many steps are taken
    where a list is left, none elsewhere. ``vals`` is bound once, so the expression stays
    linear in size.
    """
    def flat(x: Column) -> Column:
        text = F.to_json(x)
        brackets = F.length(text) - F.length(F.replace(text, F.lit("["), F.lit("")))
        steps = F.when(F.exists(x, lambda e: as_array(e).isNotNull()), F.sequence(F.lit(1), brackets)) \
            .otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, x, lambda acc, _: F.flatten(F.transform(acc, _expand)))

    return F.get(F.transform(F.array(vals), flat), 0)


def terminal(v: Column, path: str | Sequence[str], sep: str = ".",
             repair: Repair | None = None, first: Column | None = None) -> Column:
    """Compile the terminal value of ``path`` in record column ``v``.

    ``first`` is what ``v`` has at the path's first key, where that was taken before: taking a
    key copies all that is below it.
    """
    keys = split_path(path, sep)
    if not keys:  # the record itself
        return _ended(F.coalesce(as_array(v).isNotNull(), F.lit(False)), _expand(v))

    def step(vals: Column | None, is_list: Column, i: int) -> Column:
        child = F.array(first) if vals is None else F.transform(vals, _getter(keys[i]))
        last = i == len(keys) - 1

        def inside(c: Column) -> Column:
            listed = is_list | F.coalesce(F.exists(c, lambda e: as_array(e).isNotNull()), F.lit(False))
            if last and repair is not None and not repair.is_noop():
                below = F.flatten(F.transform(c, lambda e: repair_expand(e, repair)))
            else:
                below = F.flatten(F.transform(c, _expand))
            return _ended(listed, below) if last else step(below, listed, i + 1)

        return F.get(F.transform(F.array(child), inside), 0)  # bound: what is taken at a key is used twice

    return step(F.array(v) if first is None else None, F.lit(False), 0)


def _ended(is_list: Column, vals: Column) -> Column:
    return F.struct(is_list.alias("is_list"), F.transform(_flat(vals), as_python_value).alias("vals"))


def get_in(v: Column, path: str | Sequence[str], sep: str = ".", strict: bool = False) -> Column:
    """The raw sub-tree at ``path`` as VARIANT; a list on the way is mapped to the list of
    what its elements have there.

    Lenient by default (missing -> NULL). ``strict=True`` raises an error when a key is
    missing or something else than an object or list stands in the way.
    """
    def walk(x: Column, keys: tuple[str, ...]) -> Column:
        if not keys:
            return x
        child = get_key(x, keys[0])
        if strict:
            child = F.when(x.isNull() | ~is_object(x) | child.isNull(),
                           F.raise_error(F.lit(f"path key not found: {keys[0]}"))).otherwise(child)
        if len(keys) == 1:
            return child
        mapped = F.to_variant_object(F.transform(as_array(child), lambda e: walk(e, keys[1:])))
        return F.when(as_array(child).isNotNull(), mapped).otherwise(walk(child, keys[1:]))

    return walk(v, split_path(path, sep))


# --- typed views of a terminal ------------------------------------------------

def t_is_list(t: Column) -> Column:
    return t.getField("is_list")


def t_vals(t: Column) -> Column:
    return t.getField("vals")


def t_scalar(t: Column) -> Column:
    return F.get(t.getField("vals"), 0)


def t_strings(t: Column) -> Column:
    """All values as strings (NULL stays NULL)."""
    return F.transform(t_vals(t), vstr)


def t_first_string(t: Column) -> Column:
    """First value of a list, or the scalar; NULL for an empty list or nothing."""
    return vstr(t_scalar(t))


def t_string(t: Column) -> Column:
    """Scalar text of a single-valued field; NULL for lists and nothing."""
    return F.when(~t_is_list(t), vstr(t_scalar(t)))


def t_value_list(t: Column) -> Column:
    """Values of a (multi-)label field: a scalar is a one-element list, None is empty.

    NULL elements inside a list stay: they are a category of their own.
    """
    return F.when(t_is_list(t), t_strings(t)) \
        .when(t_scalar(t).isNull(), F.array().cast("array<string>")) \
        .otherwise(F.array(vstr(t_scalar(t))))


def t_contains_string(t: Column, value: str) -> Column:
    """``value`` among the values (list) or equal to the scalar; never NULL."""
    return F.coalesce(F.exists(t_vals(t), lambda x: is_string(x) & (vstr(x) == F.lit(value))),
                      F.lit(False))


# --- leaf discovery -----------------------------------------------------------

#: Levels that one pass walks inside a record's row.
LEVELS = 8
_OPEN = "array<struct<path:array<string>,node:variant>>"


def _is_container(x: Column) -> Column:
    return F.coalesce(as_array(x).isNotNull() | is_object(x), F.lit(False))


def _walked(path: Column, node: Column) -> Column:
    """``struct<found, open>``: leaf paths down to LEVELS levels below ``node``, and the containers left there."""
    none = F.array().cast("array<array<string>>")

    def inside(e: Column) -> Column:
        # an object's members by key, a list's elements under the same path
        members = F.map_entries(F.try_variant_get(e["node"], "$", "map<string,variant>"))
        return F.when(as_array(e["node"]).isNotNull(), F.transform(
            as_array(e["node"]), lambda x: F.struct(e["path"].alias("path"), x.alias("node")))).otherwise(
            F.transform(members, lambda m: F.struct(F.concat(e["path"], F.array(m["key"])).alias("path"), m["value"].alias("node"))))

    def level(acc: Column, _) -> Column:
        kids = F.flatten(F.transform(acc["open"], inside))
        return F.get(F.transform(F.array(kids), lambda ks: F.struct(
            F.array_distinct(F.concat(acc["found"], F.transform(
                F.filter(ks, lambda k: ~_is_container(k["node"])), lambda k: k["path"]))).alias("found"),
            F.filter(ks, lambda k: _is_container(k["node"])).alias("open"))), 0)

    top = F.array(F.struct(path.alias("path"), node.alias("node")))
    start = F.struct(none.alias("found"), F.filter(top, lambda e: _is_container(e["node"])).alias("open"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, level)


def leaf_paths(records: DataFrame, col: str = "v", sep: str = ".") -> DataFrame:
    """Distinct leaf paths of all records: ``(path STRING, depth INT)``.

    Lists add no path segment; an empty object or list contributes nothing. Each record is walked
    inside its row, and each task sends its distinct paths only; just these few are written. A record that
    is deeper than LEVELS is walked on from there in another pass, however deep it is.
    """
    top = F.array().cast("array<string>")
    # a NULL record is no container and has no paths; a filter for it would be pushed down and make every record there
    nodes = records.select(top.alias("path"), F.col(col).alias("node"))
    found = []
    while True:
        walked = nodes.select(_walked(F.col("path"), F.col("node")).alias("w"))
        deeper = F.when(F.size("w.open") > 0, F.array(F.lit(None).cast("array<string>"))) \
            .otherwise(F.array().cast("array<array<string>>"))
        found.append(materialize(walked.select(F.explode(F.concat("w.found", deeper)).alias("path")).distinct(), "leaves"))
        if found[-1].where("path IS NULL").isEmpty():
            break
        nodes = walked.select(F.explode("w.open").alias("e")).select("e.path", "e.node")
    paths = reduce(DataFrame.unionByName, found).where("path IS NOT NULL").distinct()
    return paths.select(F.array_join("path", sep).alias("path"), F.size("path").alias("depth")).distinct()


def sampled_leaf_paths(records: DataFrame, rate: float, key: str, col: str = "v", sep: str = ".") -> DataFrame:
    """Leaf paths of every k-th record in the order of ``key``, k = ceil(1 / rate), from the first."""
    from corpuskit.operators.ordinal import with_ordinal

    ids = with_ordinal(records.select(key), [key], "__at").where(F.col("__at") % math.ceil(1 / rate) == 0).select(key)
    return leaf_paths(records.join(ids, key, "left_semi"), col, sep)
