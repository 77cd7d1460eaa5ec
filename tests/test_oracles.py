"""Registered queries against their DuckDB oracles on the smallest scale factor."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from corpuskit.plans.registry import ORACLES, QUERIES  # filled by the entry module

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SKIP: set[str] = set()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() >= 0 and "support" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    missing = set(QUERIES) - set(ORACLES)
    assert not missing


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(ORACLES) - SKIP))
def test_query_matches_oracle(spark, sf, con, name):
    df = queries()[name](spark, sf)
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())
