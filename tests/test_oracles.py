"""Every registered query on the given tables against its SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, normal

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = con.execute(sql).df()
    a, b = normal(got), normal(want)
    assert list(a.columns) == list(b.columns)
    assert a.equals(b)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
