"""Every registered query with SQL gives the same rows in both engines; the others run."""

import glob
import os

import duckdb
import pytest

from framespan.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(name, spark, duck):
    found = registry.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    rows = sorted(repr(tuple(r)) for r in found.select(*columns).collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({sql})")
    assert rows == sorted(map(repr, expected.fetchall()))
