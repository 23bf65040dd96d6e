"""The queries that SQL can express against their DuckDB SQL on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from rateflow.llm.queries import ORACLE_SQL, QUERIES

SF_SMALL = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    result = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(result.fetchall())
