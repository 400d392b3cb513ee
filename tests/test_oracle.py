"""Every query with an oracle matches DuckDB on sf0.001 (order-insensitive, exact values)."""

from __future__ import annotations

import math
import os
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def test_every_query_is_registered_with_a_callable():
    qs = E.queries()
    assert len(qs) >= 70 and set(SQL) <= set(qs)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(SQL[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(d_cols, res.fetchall())
