"""Every query with SQL against DuckDB, and the entry point."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SQL = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("p6_")}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(_plain(x) for x in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted((tuple(_plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).columns == ["article_id", "field_name", "utc_time"]


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - {k for k in entry.queries() if k.startswith("p")}))
def test_query_without_sql_runs(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0
