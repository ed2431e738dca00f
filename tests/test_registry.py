"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "points_rank" in df.columns


def test_registry_complete():
    assert len(KEYS) >= 100
    assert set(E.oracle_sql()) <= set(KEYS)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(cols) > 0
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(cols, srows) == rows_of(dcols, drows)
