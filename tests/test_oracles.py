"""Every query against its DuckDB text over the same files."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as suite

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = suite.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(map(repr, frame.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    found = suite.queries()[name](spark, SF_DIR).toPandas()
    wanted = duck.execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert len(wanted) > 0
    assert [str(t) for t in found[sorted(found)].dtypes] == [str(t) for t in wanted[sorted(wanted)].dtypes]
    assert canonical(found) == canonical(wanted)


@pytest.mark.parametrize("name", sorted(set(suite.queries()) - set(ORACLES)))
def test_runs(spark, name):
    assert suite.queries()[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(suite.queries())
