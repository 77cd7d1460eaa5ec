"""Queries of the corpus operators against their DuckDB SQL on the smallest scale factor."""
import math

import duckdb
import pytest

from corpuskit.llm import queries as llm


def _row(values):
    return tuple(round(v, 6) if isinstance(v, float) and math.isfinite(v) else v for v in values)


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_its_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    result = con.execute(llm.ORACLES[name])
    columns = [d[0] for d in result.description]
    want = sorted(map(_row, result.fetchall()), key=repr)
    df = llm.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(_row, df.select(*columns).collect()), key=repr) == want
