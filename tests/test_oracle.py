"""Every registered query with SQL gives the rows that DuckDB gives on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from hydrolake.plans import registry
from tests import test_models

SF = "/root/testdata/sf0.001"
NAMES = sorted(registry.queries())


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.3f}".replace("-0.000", "0.000")
    return str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rows = df.collect()
    text = registry.oracle_sql().get(name)
    if text is None:  # what these must hold is tested in test_models.py
        assert name in test_models.TESTED and rows
        return
    cur = duck.execute(text)
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    order = sorted(columns)
    assert sorted(df.columns) == order
    at = [columns.index(c) for c in order]
    assert sorted(tuple(plain(r[c]) for c in order) for r in rows) == sorted(tuple(plain(r[i]) for i in at) for r in want)
