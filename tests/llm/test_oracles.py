"""Queries of this subpackage against their SQL."""

import duckdb
import pytest

from onomast.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(con.sql(ORACLES[name]).columns) == columns
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want))
