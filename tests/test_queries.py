"""Every registered query against its DuckDB oracle on the smallest scale (as the driver does at sf0.01)."""

import datetime as dt
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from weekly_impact.plans.oracle import oracle_queries
from weekly_impact.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ["part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(oracle_queries()) == set(all_queries())


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = df.collect()
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    orows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    assert Counter(tuple(map(_norm, r)) for r in rows) == Counter(tuple(map(_norm, r)) for r in orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["week", "category"]
    assert df.count() >= 0
    assert os.path.isdir(SF)
