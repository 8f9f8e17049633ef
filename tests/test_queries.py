"""Every registered query against its SQL, on the smallest tables."""
import os

import pytest

import __spark_entry__ as contract
import check

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables missing")


@pytest.fixture(scope="module")
def db():
    import duckdb
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    got = check.canonical(df.collect(), df.columns)
    assert got[1], "no rows"
    if name in SQL:
        cursor = db.execute(SQL[name])
        columns = [c[0] for c in cursor.description]
        assert got == check.canonical(cursor.fetchall(), columns)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "id" and df.count() > 0
