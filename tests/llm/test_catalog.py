"""Registered queries against DuckDB on the given tables."""

import os

import duckdb
import pytest

from subtally.llm import catalog

TABLES = ("documents", "embeddings", "pages", "labels", "benchmark", "conversations")


@pytest.mark.parametrize("key", list(catalog.oracle_sql()))
def test_matches_duckdb(spark, sf_dir, key):
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS FROM '{path + '/*' if os.path.isdir(path) else path}'")
    result = con.execute(catalog.oracle_sql()[key])
    columns = [c[0] for c in result.description]
    frame = catalog.queries()[key](spark, sf_dir)
    assert sorted(frame.columns) == sorted(columns)
    rows = frame.select(*columns).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(result.fetchall(), key=repr)


def test_a_query_for_each_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in catalog.queries())
    assert numbers == list(range(1, 14))
