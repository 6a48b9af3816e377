"""Every registered query against its SQL twin on DuckDB (the driver's gate),
at sf0.001: same columns, same row count, same order-free values."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from gapledger.plans.registry import ORACLE as SQL, QUERIES
from gapledger.sources.tables import TABLES



def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def con(base):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, base, con, name):
    df = QUERIES[name](spark, base)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["account_id", "period", "crm_total", "ledger_total", "net_gap", "abs_gap"]
    assert df.count() >= 0
