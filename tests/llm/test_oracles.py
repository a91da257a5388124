"""The corpus queries that SQL can express, against DuckDB on the sf0.001 tables."""

import os

import duckdb
import pytest

from isobar.llm import queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = queries.QUERIES[name](spark, SF)
    rel = con.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == sorted(sdf.columns)
    at = [rel.columns.index(c) for c in sdf.columns]
    expect = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r) for r in sdf.collect()), key=str) == expect
