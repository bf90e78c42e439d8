"""Every registered query runs on the smallest tables; those with SQL give the same rows."""

import datetime
import glob
import os

import duckdb
import pytest

from qaforge.plans import catalog


def rows(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else float(v) if isinstance(v, float) else v
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, small, sql, name):
    df = catalog.QUERIES[name](spark, small)
    got = rows([tuple(r) for r in df.collect()], df.columns)
    cur = sql.execute(catalog.ORACLES[name])
    want = rows(cur.fetchall(), [c[0] for c in cur.description])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, small, name):
    assert catalog.QUERIES[name](spark, small).collect() is not None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
