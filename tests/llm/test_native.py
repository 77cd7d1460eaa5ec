"""Mixing and sharding: laws, moments, odd rows, and the SQL of the mix."""

import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import hash_tree, poisson_mix, q_native
from corpuskit.llm.hash_tree import Leaf


def test_mix_equals_sql(spark, sf):
    got = q_native.op9_poisson_mix(spark, sf).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(q_native.MIX_SQL).fetchdf()
    cols, by = sorted(got.columns), ["doc_id", "copy"]
    assert sorted(want.columns) == cols
    assert got[cols].sort_values(by).values.tolist() == want[cols].sort_values(by).values.tolist()
    assert got.shuffle_key.is_monotonic_increasing


@pytest.mark.parametrize("mean", [0.3, 4.0, 31.0, 75.5, 900.0])
def test_poisson_moments(spark, mean):
    n = spark.range(4000).select(poisson_mix.poisson_count(F.lit(mean), F.lit("t"), F.col("id")).alias("n"))
    avg, var = n.agg(F.avg("n"), F.var_samp("n")).first()
    assert abs(avg - mean) < 5 * math.sqrt(mean / 4000)
    assert abs(var - mean) < 0.15 * mean + 0.05


def test_poisson_inverts_the_distribution(spark):
    """P(N <= n) at the draw brackets the uniform number."""
    rows = spark.range(300).select(F.col("id"), poisson_mix.unit(F.lit("t"), F.col("id"), F.lit(1)).alias("u"),
                                   poisson_mix.poisson_count(F.lit(2.5), F.lit("t"), F.col("id")).alias("n")).collect()
    cdf = [sum(math.exp(-2.5) * 2.5**j / math.factorial(j) for j in range(k + 1)) for k in range(40)]
    for r in rows:
        assert (r.n == 0 or cdf[r.n - 1] <= r.u + 1e-12) and r.u < cdf[r.n] + 1e-12


def test_mix_odd_rows(spark, odd, empty):
    rates = spark.createDataFrame([("s", 2.0), (None, 1.0), ("gone", 5.0)], "source string, rate double")
    got = poisson_mix.poisson_mix(odd.withColumn("copy", F.lit("x")), rates)
    rows = got.collect()
    assert {r.copy for r in rows} and all(1 <= r.copy <= r.n_copies for r in rows)
    per = Counter((r.doc_id, r.text, r.n) for r in rows)
    assert all(per[(r.doc_id, r.text, r.n)] == r.n_copies for r in rows)
    assert poisson_mix.poisson_mix(empty, rates).count() == 0
    assert poisson_mix.rates_by_power(empty).count() == 0
    nulls = odd.withColumn("source", F.lit(None).cast("string"))
    assert poisson_mix.poisson_mix(nulls, rates).count() > 0
    none = spark.createDataFrame([("s", 0.0)], "source string, rate double")
    assert poisson_mix.poisson_mix(odd, none).count() == 0


@pytest.mark.parametrize("power", [0.0, 0.5, 1.0])
def test_sources_without_text_have_rate_zero(spark, power):
    rows = [(1, "abcd", "s"), (2, "", "s"), (3, None, "empty"), (4, "", "empty"), (5, "ab", None), (6, None, "null")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r.source: r.rate for r in poisson_mix.rates_by_power(docs, power, epochs=50.0).collect()}
    assert set(rates) == {"s", "empty", "null", None} and rates["empty"] == rates["null"] == 0.0
    assert math.isclose(4 * rates["s"] + 2 * rates[None], 50.0 * 6)
    drawn = poisson_mix.poisson_mix(docs, poisson_mix.rates_by_power(docs, power, epochs=50.0)).collect()
    assert {r.doc_id for r in drawn} == {1, 2, 5}  # empty texts only of sources that have text
    none = docs.where("source in ('empty', 'null')")
    assert [r.rate for r in poisson_mix.rates_by_power(none, power).collect()] == [0.0, 0.0]


def test_many_sources_join_without_broadcast(spark, odd, monkeypatch):
    rates = spark.createDataFrame([("s", 2.0), ("t", 1.0)], "source string, rate double")
    want = sorted((r.doc_id or -1, r.copy) for r in poisson_mix.poisson_mix(odd, rates).collect())
    monkeypatch.setattr(poisson_mix, "BROADCAST_ROWS", 1)
    assert sorted((r.doc_id or -1, r.copy) for r in poisson_mix.poisson_mix(odd, rates).collect()) == want


def _check_slots(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_sharding(spark, sf, monkeypatch):
    monkeypatch.setattr(hash_tree, "ROWS_PER_BUCKET", 40)  # several buckets
    rows = q_native.op10_hash_tree(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    import zlib

    assert len(rows) == len(docs)
    for r in rows:
        body = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law) == (len(body) + 16, zlib.crc32(body), "key")
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    _check_slots(rows)


def test_one_more_shard_takes_only_into_itself(spark):
    tree = hash_tree.even_tree(40)
    keys = spark.range(20000).select(hash_tree.descend(F.col("id"), tree).alias("a"),
                                     hash_tree.descend(F.col("id"), hash_tree.grown(tree)).alias("b"),
                                     hash_tree.descend(F.col("id"), hash_tree.grown(hash_tree.grown(tree))).alias("c")).collect()
    assert {k.b for k in keys if k.a != k.b} == {40} and {k.c for k in keys if k.b != k.c} == {41}
    moved = sum(k.a != k.b for k in keys)
    assert abs(moved - 20000 / 41) < 5 * math.sqrt(20000 / 41)
    sizes = Counter(k.a for k in keys)
    assert all(abs(sizes[s] - 500) < 6 * math.sqrt(500) for s in range(40))


def test_weights_and_movement_stay_in_changed_subtrees(spark):
    tree = [Leaf(0, 0, 0, 1.0), Leaf(0, 0, 1, 3.0), Leaf(0, 1, 2, 2.0), Leaf(1, 0, 3, 2.0), Leaf(1, 0, 4, 0.0)]
    less = [Leaf(0, 0, 0, 1.0), Leaf(0, 0, 1, 1.0), *tree[2:]]
    rows = spark.range(16000).select(hash_tree.descend(F.col("id"), tree).alias("a"),
                                     hash_tree.descend(F.col("id"), less).alias("b")).collect()
    share = Counter(r.a for r in rows)
    for leaf in tree:
        assert abs(share[leaf.shard] - 2000 * leaf.weight) <= 6 * math.sqrt(2000 * leaf.weight)
    # what shrank gives: nothing leaves region 1, and from rack 1 rows go only where region 0 lost them
    assert all(r.b == 3 for r in rows if r.a == 3)
    assert {r.b for r in rows if r.a == 2} <= {2, 3} and {r.b for r in rows if r.a == 0} <= {0, 2, 3}


def test_sharding_odd_rows(spark, odd, empty):
    rows = hash_tree.shard_documents(odd, hash_tree.even_tree(6)).collect()
    assert len(rows) == odd.count()
    _check_slots(rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.shard)
    assert all(len(s) == 1 for s in by.values())
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 3} == {(16, 0)}
    assert hash_tree.shard_documents(empty, hash_tree.even_tree(6)).count() == 0


def test_hot_key_is_numbered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(hash_tree, "ROWS_PER_BUCKET", 50)
    hot = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = hash_tree.shard_documents(hot, hash_tree.even_tree(5)).collect()
    assert len({r.shard for r in rows}) == 1
    _check_slots(rows)
