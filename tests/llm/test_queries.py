"""The operators' queries over awkward copies of the smallest tables."""

import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from pairlake.llm import catalogue

FOLDER = "/root/testdata/sf0.001"
FOUND = [n for n in catalogue.queries() if n.endswith("_found") or n in ("p5_cutoffs", "p7_percentiles", "p8_fill")]
CLASH = ["site", "case_no", "rank", "level_site", "root", "entity", "n", "value", "kind", "score", "source", "cutoff", "population", "category", "h", "k1", "r", "g", "size", "certainty", "at_", "host_", "pb", "f0"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Every row twice, a row of nulls, and further columns whose names the operators use themselves."""
    out = tmp_path_factory.mktemp("awkward")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        df = spark.read.parquet(f)
        nulls = spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in df.dtypes])
        both = df.unionByName(df).unionByName(nulls).withColumns({c: F.lit(7) for c in CLASH if c not in df.columns})
        both.write.parquet(str(out / os.path.basename(f)))
    return str(out)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("empty")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        spark.read.parquet(f).limit(0).write.parquet(str(out / os.path.basename(f)))
    return str(out)


@pytest.mark.parametrize("name", FOUND)
def test_repeated_rows_nulls_and_clashing_names_change_nothing(spark, awkward, name):
    run = catalogue.queries()[name]
    rows = lambda folder: sorted((tuple(map(str, r)) for r in run(spark, folder).collect()))
    assert rows(awkward) == rows(FOLDER)


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_empty_tables(spark, empty, name):
    out = catalogue.queries()[name](spark, empty).collect()
    assert out == [] or name == "p8_fill"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if sql := catalogue.oracle_sql().get(name):
        res = duck.execute(sql)
        have = [d[0] for d in res.description]
        assert sorted(have) == cols
        assert sorted((tuple(plain(r[have.index(c)]) for c in cols) for r in res.fetchall()), key=repr) == got
