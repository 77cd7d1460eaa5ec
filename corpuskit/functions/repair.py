"""Value repair (drop / remap) at a path.

Records are never rewritten. A repair is applied while the terminal value of its
path is compiled (see ``paths.terminal``): at the leaf, a scalar is remapped and
becomes NULL when dropped, a list has its scalars remapped and dropped ones
removed, objects and nested lists are left alone. A leaf reached through a list
of objects is a scalar leaf per object, so a drop leaves a NULL in place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.variant import as_array, equals_value, in_values, is_boolean, is_number, \
    is_object, is_string, literal_variant, vstr


@dataclass(frozen=True)
class Repair:
    drop: frozenset = field(default_factory=frozenset)
    remap: tuple = ()  # tuple of (old, new) pairs, hashable

    @staticmethod
    def of(drop=(), remap=None) -> "Repair":
        drop = frozenset(drop or ())
        remap = dict(remap or {})
        if None in drop or None in remap:
            raise ValueError("dropping or remapping None is not supported")
        return Repair(drop, tuple(remap.items()))

    @property
    def remap_dict(self) -> dict:
        return dict(self.remap)

    def is_noop(self) -> bool:
        return not self.drop and not self.remap


def repairs_from(dropped_values: dict | None, remapped_values: dict | None) -> dict[str, Repair]:
    """One Repair per field in either mapping; a missing side counts as empty."""
    dropped_values = dropped_values or {}
    remapped_values = remapped_values or {}
    fields = set(dropped_values) | set(remapped_values)
    return {str(f): Repair.of(dropped_values.get(f, ()), remapped_values.get(f, {}))
            for f in sorted(fields, key=str)}


def _remap(x: Column, mapping: dict) -> Column:
    if not mapping:
        return x
    strings = {k: v for k, v in mapping.items() if isinstance(k, str)}
    out = x
    if strings:  # one lookup, whatever the size of the mapping
        table = F.create_map(*[c for k, v in strings.items() for c in (F.lit(k), F.lit(json.dumps(v)))])
        hit = F.when(is_string(x), F.try_element_at(table, vstr(x)))
        out = F.when(hit.isNotNull(), F.parse_json(hit)).otherwise(out)
    for k, v in mapping.items():
        if not isinstance(k, str):
            out = F.when(equals_value(x, k), literal_variant(v)).otherwise(out)
    return out


def _is_scalar(x: Column) -> Column:
    return is_string(x) | is_number(x) | is_boolean(x)


def repair_scalar(x: Column, repair: Repair) -> Column:
    """Remap, then NULL when dropped (objects and arrays untouched)."""
    if repair.is_noop():
        return x
    r = _remap(x, repair.remap_dict)
    dropped = in_values(r, repair.drop) if repair.drop else F.lit(False)
    return F.when(_is_scalar(x), F.when(dropped, F.lit(None)).otherwise(r)).otherwise(x)


def repair_list(arr: Column, repair: Repair) -> Column:
    """Remap scalars, remove dropped ones; objects and nested lists stay; order kept."""
    if repair.is_noop():
        return arr
    mapping = repair.remap_dict
    remapped = F.transform(arr, lambda e: F.when(_is_scalar(e), _remap(e, mapping)).otherwise(e))
    if not repair.drop:
        return remapped
    return F.filter(remapped, lambda e: ~(in_values(e, repair.drop)))


def repair_expand(c: Column, repair: Repair) -> Column:
    """Repair one leaf value and return its elements as an array (scalar -> 1 element)."""
    arr = as_array(c)
    return F.when(arr.isNotNull(), repair_list(arr, repair)) \
        .otherwise(F.array(F.when(is_object(c), c).otherwise(repair_scalar(c, repair))))


def repaired_record(record, repairs: dict[tuple, Repair]):
    """A record as Python values, with the repairs made in place (for filters on whole records)."""
    for path, repair in repairs.items():
        if not repair.is_noop():
            _repair_at(record, path, repair)
    return record


def _repair_at(node, path: tuple, repair: Repair) -> None:
    if isinstance(node, list):
        for x in node:
            _repair_at(x, path, repair)
        return
    if not isinstance(node, dict) or path[0] not in node:
        return
    if len(path) > 1:
        _repair_at(node[path[0]], path[1:], repair)
        return
    plain = lambda x: isinstance(x, (str, int, float, bool))
    changed = lambda x: _looked_up(x, repair) if plain(x) else x
    gone = lambda x: plain(x) and any(_same(x, d) for d in repair.drop)
    value = node[path[0]]
    if isinstance(value, list):
        node[path[0]] = [x for x in map(changed, value) if not gone(x)]
    else:
        value = changed(value)
        node[path[0]] = None if gone(value) else value


def _same(x, y) -> bool:
    return x == y and isinstance(x, str) == isinstance(y, str)


def _looked_up(x, repair: Repair):
    return next((new for old, new in repair.remap if _same(x, old)), x)
