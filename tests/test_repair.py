"""Value repair: scalar remap-then-drop, list removal, nested lists of objects."""

from pyspark.sql import functions as F

from conftest import records
from corpuskit.functions.paths import t_vals
from corpuskit.functions.variant import vstr
from corpuskit.sources.records import extract_table


def _vals(spark, recs, path, drop, remap):
    out = extract_table(records(spark, recs), {"t": path}, dropped_values={path: drop},
                        remapped_values={path: remap}, keep=["rid"])
    rows = out.select("rid", F.transform(t_vals(F.col("t")), vstr).alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["rid"])]


def test_scalar_and_list(spark):
    recs = [{"x": "a"}, {"x": "b"}, {"x": ["a", "b", "c", "a"]}, {"x": 1}, {}]
    got = _vals(spark, recs, "x", {"b"}, {"a": "b", "c": "z"})
    # remap first, then drop: "a" -> "b" -> dropped
    assert got == [[None], [None], ["z"], ["1"], [None]]


def test_nested_objects_leave_nulls(spark):
    recs = [{"dict": [{"a": 1}, {"a": 2}, {"a": 3, "b": ["foo"]}, {"foo": "bar"}]}]
    got = _vals(spark, recs, "dict.a", {2}, {1: 5})
    assert got == [["5", None, "3", None]]


def test_remap_to_null_is_kept_in_lists(spark):
    got = _vals(spark, [{"x": ["a", "b"]}], "x", set(), {"a": None})
    assert got == [[None, "b"]]
