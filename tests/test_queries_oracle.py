"""Every registered query against its DuckDB oracle on sf0.001 (the driver's gate runs sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("STATSWEEP_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(entry.queries())


def _norm(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in entry.TABLES if hasattr(entry, "TABLES") else ():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    if sql is None:
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    b = sorted(tuple(_norm(r[i]) for i in dorder) for r in res.fetchall())
    assert a == b
