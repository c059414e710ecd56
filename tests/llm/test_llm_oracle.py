"""Queries of the training-data operators against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from hydrolake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    cur = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    order = sorted(columns)
    assert sorted(df.columns) == order
    want = sorted(tuple(str(r[columns.index(c)]) for c in order) for r in cur.fetchall())
    assert sorted(tuple(str(r[c]) for c in order) for r in df.collect()) == want
