"""Queries that SQL can express, against their SQL twins at sf0.001."""

import duckdb
import pytest

from gapledger.llm.queries import ORACLE, QUERIES
from gapledger.sources.tables import TABLES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, base, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{base}/{t}.parquet')")
    got = QUERIES[name](spark, base)
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, got.select(*columns).collect())) == sorted(
        "Row(" + ", ".join(f"{c}={v!r}" for c, v in zip(columns, r)) + ")" for r in cur.fetchall())


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
