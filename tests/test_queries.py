"""Every registered query beside its SQL, and the shape of the plans."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_its_sql(spark, db, name):
    df = queries()[name](spark, SF_DIR)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = db.execute(sql)
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == ordered(columns, cur.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


def test_entry(spark):
    assert entry(spark).count() > 0
