"""Registered queries against their independent SQL on the smallest tables.

The headline queries run by default; PAYPANEL_ORACLES=all runs every one (about ten minutes).
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from bench import HEADLINE
from checks import registry
from checks.compare import TABLES, rows_of

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
RUN = list(QUERIES) if os.environ.get("PAYPANEL_ORACLES") == "all" else HEADLINE


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert len(registry.QUERIES) - len(registry.ORACLES) < 15


@pytest.mark.parametrize("name", RUN)
def test_query(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name not in ORACLES:
        assert got, name
        return
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(got, df.columns) == rows_of(rel.fetchall(), rel.columns)
