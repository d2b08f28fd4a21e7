"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from quire import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(tuple, df[columns].astype(str).itertuples(index=False))), columns


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    got, want = rows(registry.queries()[name](spark, SF).toPandas()), rows(duck.sql(registry.oracle_sql()[name]).df())
    assert got[1] == want[1]
    assert got[0] == want[0]


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry():
    import __spark_entry__ as e

    assert "u1_multiset_diff" in e.queries()
    assert set(e.oracle_sql()) <= set(e.queries())
