"""Path walks, terminals and leaf discovery against the pure-Python model."""

import random

from pyspark.sql import functions as F

from conftest import records
from corpuskit.functions.paths import get_in, leaf_paths, sampled_leaf_paths, t_is_list, t_vals, terminal
from corpuskit.functions.variant import vstr
from corpuskit.sources.records import extract_table
import model


def _random_value(rng, depth=0):
    r = rng.random()
    if depth > 2 or r < 0.35:
        return rng.choice([None, 0, 1, 2.5, "", "a", "b", "ccm:io"])
    if r < 0.65:
        return [_random_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {k: _random_value(rng, depth + 1) for k in rng.sample(["a", "b", "c"], rng.randint(0, 3))}


def _python_view(x):
    """Compare values as text, like the Spark side renders scalars."""
    if x is None:
        return None
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, float) and x.is_integer():
        return str(x)
    return str(x)


def test_terminal_matches_model(spark):
    rng = random.Random(7)
    recs = [{k: _random_value(rng) for k in rng.sample(["a", "b", "c"], rng.randint(1, 3))}
            for _ in range(300)]
    df = records(spark, recs)
    paths = ["a", "a.b", "b.c.a", "c.a"]
    cols = []
    for i, p in enumerate(paths):
        t = terminal(F.col("v"), p)
        cols += [t_is_list(t).alias(f"l{i}"), F.transform(t_vals(t), vstr).alias(f"v{i}")]
    got = {r["rid"]: r for r in df.select("rid", *cols).collect()}
    for rid, rec in enumerate(recs):
        for i, p in enumerate(paths):
            expect = model.terminal(rec, p)
            row = got[rid]
            assert row[f"l{i}"] == isinstance(expect, list), (rec, p)
            vals = expect if isinstance(expect, list) else [expect]
            assert [_python_view(x) for x in vals] == row[f"v{i}"], (rec, p, row[f"v{i}"])


def test_leaf_paths_of_one_record(spark):
    rec = {"shop": {"name": "n", "open": [9, 18], "staff": [{"id": 4}, {"id": 5, "tags": {"vip": True}}]}, "note": None, "box": {}}
    got = {r["path"] for r in leaf_paths(records(spark, [rec])).collect()}
    assert got == {"shop.name", "shop.open", "shop.staff.id", "shop.staff.tags.vip", "note"}


def test_deep_records_lose_nothing(spark):
    deep = "leaf"
    for i in range(110):
        deep = {f"k{i}": deep}
    nested = "x"
    for _ in range(12):
        nested = [nested, "y"]
    df = records(spark, [deep, {"a": nested}])
    paths = {r["path"]: r["depth"] for r in leaf_paths(df).collect()}
    assert sorted(paths.values()) == [1, 110]
    vals = df.select(F.transform(t_vals(terminal(F.col("v"), "a")), vstr).alias("x")).collect()[1].x
    assert vals == ["x"] + ["y"] * 12


def test_get_in_maps_lists_and_can_be_strict(spark):
    import pytest

    df = records(spark, [{"a": [{"b": 1}, {"c": 2}, 3], "d": {"e": {"f": 4}}}])
    got = df.select(F.to_json(get_in(F.col("v"), "a.b")).alias("x"), F.to_json(get_in(F.col("v"), "d.e")).alias("y"),
                    get_in(F.col("v"), "d.zz").alias("z")).first()
    assert got.x == "[1,null,null]" and got.y == '{"f":4}' and got.z is None
    assert vstr(get_in(F.col("v"), "d.e.f", strict=True)) is not None
    assert df.select(vstr(get_in(F.col("v"), "d.e.f", strict=True)).alias("x")).first().x == "4"
    for path in ("a.b", "d.zz", "d.e.f.g"):
        with pytest.raises(Exception, match="path key not found"):
            df.select(vstr(get_in(F.col("v"), path, strict=True))).collect()


def test_leaf_paths_random(spark):
    rng = random.Random(11)
    recs = [{k: _random_value(rng) for k in rng.sample(["a", "b", "c"], rng.randint(1, 3))}
            for _ in range(100)]
    expect = set()
    for r in recs:
        expect |= {".".join(p) for p in model.leaves(r) if p}
    got = {r["path"] for r in leaf_paths(records(spark, recs)).collect()}
    assert got == expect


def test_missing_and_premature_leaf_keep_positions(spark):
    rec = {"x": [{"y": "a"}, {"z": 1}, "s", [{"y": "b"}]]}
    t = terminal(F.col("v"), "x.y")
    row = records(spark, [rec]).select(t_is_list(t).alias("l"), F.transform(t_vals(t), vstr).alias("v")).first()
    assert row["l"] is True
    assert row["v"] == ["a", None, None, None]


def test_paths_share_their_first_key(spark):
    rows = spark.createDataFrame([(1, '{"p": {"a": ["x", null], "b": {"c": 1}}, "q": [{"r": "s"}, {}]}'), (2, '{"p": [{"a": "y"}]}'), (3, "[]")],
                                 "i int, j string").select("i", F.parse_json("j").alias("v"))
    paths = ["p.a", "p.b.c", "q.r", "p", ""]
    out = extract_table(rows, {f"c{n}": p for n, p in enumerate(paths)}, keep=["i"])
    shown = lambda c: F.to_json(F.struct(c.getField("is_list").alias("l"), c.getField("vals").alias("v")))
    got = out.select("i", *[shown(F.col(f"c{n}")) for n in range(len(paths))]).collect()
    want = rows.select("i", *[shown(terminal(F.col("v"), p)) for p in paths]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$['p']") == 1  # a key's value is copied whenever it is taken


def test_sampled_walk_builds_no_filter(spark):
    rows = spark.createDataFrame([(n, '{"a": {"b": 1}}' if n % 3 else None) for n in range(20)], "i int, j string")
    records = rows.select("i", F.parse_json("j").alias("v"))
    assert {(r.path, r.depth) for r in leaf_paths(records).collect()} == {("a.b", 2)}
    assert sampled_leaf_paths(records, 0.1, "i").count() == 1  # rows 0 and 10; 0 has no record
    assert leaf_paths(records.where("v IS NULL")).count() == 0
