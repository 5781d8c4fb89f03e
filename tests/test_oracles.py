"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as registry
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cur = duck.execute(registry.oracle_sql()[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert got == want


def test_every_query_is_registered_once_and_entry_runs(spark):
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert registry.entry(spark).count() > 0
