"""Every catalogued query against its DuckDB SQL on the supplied sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from starmart.plans import catalog
from tools.check_oracle import TABLES, digest

NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "EmployeeCount" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(ocols, want)[0]
