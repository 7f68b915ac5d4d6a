"""Every registered query against its DuckDB oracle (small scale), and the
driver contract."""

from __future__ import annotations

import importlib.util
import os

import duckdb
import pytest
from conftest import SF_SMALL

from stationlake.plans.registry import ORACLE_SQL, QUERIES

_TOOLS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools")
_spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(_TOOLS, "check_oracle.py"))
check_oracle = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check_oracle)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "supplier"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = check_oracle.compare(spark, con, SF_SMALL, name)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r
    assert r["types_match"], r


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location(
        "spark_entry", os.path.join(os.path.dirname(_TOOLS), "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.columns == ["station_id", "last_reported", "num_bikes_available"]
    assert df.count() > 0
    assert set(QUERIES) <= set(mod.queries())
    assert set(mod.oracle_sql()) <= set(mod.queries())
