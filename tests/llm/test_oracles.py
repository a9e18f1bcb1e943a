"""Registered corpus queries against their DuckDB oracles on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from gaugeflow.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of


def test_queries_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert rows and rows_of(df.columns, rows) == rows_of(columns, want)
