"""The queries that SQL can state, against DuckDB on the same tables."""

from __future__ import annotations

import duckdb
import pytest
from llm_fixtures import SF_SMALL

from stationlake.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)
