"""The queries of the subpackage against their SQL, or against what must hold, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill.llm import queries
from corpusmill.sources import scratch


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v) if not isinstance(v, (int, bool, type(None))) else v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, duck, data, name):
    df = entry.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(columns).collect()), key=str)
    want = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=str)


def test_every_query_is_registered():
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_shares_add_up(spark, data):
    rows = entry.queries()["p7_shares"](spark, data).collect()
    assert abs(sum(r["reached_share"] for r in rows) - 1) < 1e-9 and all(r["most_uses"] <= r["max_repeats"] for r in rows)


def test_what_was_written_goes(spark, data):
    df = entry.queries()["p4_found"](spark, data)
    assert df.count() >= 0 and scratch.release(spark) > 0 and scratch.release(spark) == 0
