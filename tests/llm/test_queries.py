"""Registered queries against their SQL on the supplied tables."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from starmart.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, digest


def test_one_query_an_operator_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, got)[0] == digest(names, want)[0]
