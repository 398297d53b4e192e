"""Every query runs on the smallest tables and agrees with its SQL."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry
from pairlake.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = catalogue.oracle_sql().get(name)
    if sql:
        res = duck.execute(sql)
        have = [d[0] for d in res.description]
        assert sorted(have) == cols
        assert sorted((tuple(plain(r[have.index(c)]) for c in cols) for r in res.fetchall()), key=repr) == got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
