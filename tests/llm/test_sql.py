"""Registered queries against their DuckDB SQL."""

import duckdb
import pytest

from tidemark.llm.oracles import ORACLE_SQL
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = QUERIES[key](spark, SF)
    want = con.sql(ORACLE_SQL[key])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())


def test_every_operator_is_registered_once():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
