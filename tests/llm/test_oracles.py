"""Queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from furrow.llm.queries import ORACLE, QUERIES
from tests.conftest import SF

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got.select(columns).collect()), key=str) == sorted(want.project(", ".join(columns)).fetchall(), key=str)
