"""Every registered query against its oracle at the smallest scale, and the driver contract."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import norm
from pressline.catalog import ORACLES, QUERIES, SURVEY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in glob.glob(FOLDER + "/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLES:
        assert got
        return
    rel = oracle.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    order = [rel.columns.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in order) for r in rel.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() == 2


def test_every_query_names_its_survey_rows():
    assert all(SURVEY[name] for name in QUERIES)


def test_the_entry_holds_the_catalog():
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()
