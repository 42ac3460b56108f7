"""Named queries with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from plumbline.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "pages", "embeddings", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    expected = con.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=str) == sorted(expected.fetchall(), key=str)
