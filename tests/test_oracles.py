"""Every registered query against its DuckDB oracle on the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from lakepipe import registry
from lakepipe.sources.tables import TEST_TABLES

from .conftest import SF_ORACLE, SF_SMALL


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "date_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_ORACLE)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _rows(sdf.columns, srows) == _rows(ocols, res.fetchall())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_runs_on_smallest_scale(spark, name):
    E.queries()[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()


def test_kpi_export_narrow_window_matches_oracle(spark, duck):
    """F2 boundaries: both window ends are inclusive days."""
    from datetime import datetime

    from lakepipe.plans.job import RunContext
    from lakepipe.plans.kpi_export import KpiExport, KpiExportParameters
    from lakepipe.registry import _X3_ORACLE, KPI_WINDOW
    from lakepipe.sources.fixtures import adapters
    lo, hi = "1996-02-01", "1996-02-29"
    srcs = adapters(spark, SF_ORACLE, ["customer_sales", "customer_purchases"])
    sdf = KpiExport(srcs).build(spark, KpiExportParameters(lo, hi), RunContext(as_of=datetime(2024, 1, 1)))
    sql = _X3_ORACLE.replace(f"DATE '{KPI_WINDOW[0]}'", f"DATE '{lo}'").replace(
        f"DATE '{KPI_WINDOW[1]}'", f"DATE '{hi}'")
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert len(srows) > 0
    assert _rows(sdf.columns, srows) == _rows(ocols, orows)
    days = {r[0] for r in srows}
    assert min(days).isoformat() == lo and max(days).isoformat() == hi


def test_inventory_snapshot_matches_oracle_at_sf01(spark):
    """Rounding ties of the average cost appear at sf0.1 (double-rounding guard)."""
    con = duckdb.connect()
    for t in ["lineitem", "part"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.1/{t}.parquet')")
    sdf = E.queries()["inventory_snapshot"](spark, "/root/testdata/sf0.1")
    res = con.execute(E.oracle_sql()["inventory_snapshot"])
    ocols = [d[0] for d in res.description]
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(ocols, res.fetchall())
