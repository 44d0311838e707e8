"""Every registered query against its SQL twin, on the smallest data."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as S
from check_oracle import bag

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


#: The queries of the subpackage for training text have tests of their own.
OWN = sorted(set(S.queries()) - set(S._text_queries()[0]))


def test_every_query_has_sql():
    assert set(OWN) <= set(S.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    df = S.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(S.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(rows, df.columns) == bag(res.fetchall(), columns)


def test_entry(spark):
    rows = S.entry(spark).collect()
    assert len(rows) == 8
    assert {r.type for r in rows} == {"Regression", "Count", "Null", "Duplicate"}
