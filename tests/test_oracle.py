"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import decimal
import json
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from statlake.plans import registry
from tests.conftest import SMOKE_DIR

TABLES = "region nation customer orders lineitem events pages".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return json.dumps([_norm(x) for x in v])
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return ([cols[i] for i in order],
            sorted(json.dumps([_norm(r[i]) for i in order]) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "value", "unit", "category"]
    assert len(df.collect()) > 0


registry.load_all()


def test_every_key_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert len(registry.QUERIES) >= 70
    assert set(registry.QUERIES) <= set(E.queries()) and set(registry.ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMOKE_DIR)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows
