"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = sorted(n for n in entry.catalogue.QUERIES)


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v) if not isinstance(v, (int, bool, type(None))) else v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, data, name):
    df = entry.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(columns).collect()), key=str)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=str)


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0
