"""Queries that SQL can express, against their SQL on the same tables."""

from __future__ import annotations

import duckdb
import pytest

from lakepipe.llm.queries import ORACLES, QUERIES

from ..conftest import SF_ORACLE


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_ORACLE)
    assert sorted(got.columns) == sorted(names)
    rows = sorted((tuple(r) for r in got.select(*names).collect()), key=str)
    assert rows == sorted(want.fetchall(), key=str) and rows
