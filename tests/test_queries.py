"""Every query against its SQL in DuckDB, over the smallest data."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.conftest import DATA

QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(data):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    return con


def plain(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, duck):
    df = QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if name not in SQL:
        assert got
        return
    cur = duck.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def test_entry(spark, data):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert "message_count" in df.columns
    assert DATA in ("/root/testdata/sf0.001",)
