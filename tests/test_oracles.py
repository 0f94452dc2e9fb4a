"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, _norm  # noqa: E402

SQL = entry._ORACLES
QUERIES = entry.QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    s = QUERIES[name](spark, SF_SMALL).toPandas()
    d = duck.sql(SQL[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _norm(s, 9) == _norm(d, 9)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "label" in df.columns
