"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tvpulse.sources.testdata import TABLES

from conftest import SF001

ORACLES = E.oracle_sql()
SLOW = {"search_text_topk"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    return v


def _canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_is_registered_and_entry_runs(spark):
    assert set(ORACLES) <= set(E.queries())
    df = E.entry(spark)
    assert df.columns == ["NETWORK_ID", "DISTINCT_REACH", "TOTAL_MINUTES", "TOTAL_SESSIONS"]
    assert df.count() == 5


@pytest.mark.parametrize("key", sorted(k for k in ORACLES if k not in SLOW))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF001)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert _canon(sdf.columns, s_rows) == _canon(d_cols, d_rows)
