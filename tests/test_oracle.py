"""Each query with SQL gives DuckDB's rows."""

import glob
import os

import pytest

from sokhan import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def rows(found, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in found)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, duck, name):
    df, want = registry.queries()[name](spark, SF), duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)
