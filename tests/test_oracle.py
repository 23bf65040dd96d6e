"""Every SQL-expressible query against its DuckDB oracle on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import SF_SMALL
from oracle_sql import oracle_sql
from rateflow.plans.queries import QUERIES as PLANS

TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events"]
SQL = oracle_sql()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in PLANS}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_entry():
    model_queries = {"gbt_predictions_small", "gbt_error_hist_small", "als_predictions"}
    assert set(QUERIES) - set(SQL) == model_queries
    assert set(SQL) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _rows(df.columns, df.collect())
    res = duck.execute(SQL[name])
    cols = [c[0] for c in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert sum(got.values()) == sum(want.values())
    assert got == want
