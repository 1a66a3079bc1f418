"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = entry.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in ("documents", "lineitem", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert entry._own_queries().keys() == entry._own_sql().keys()


@pytest.mark.parametrize("name", list(entry._own_queries()))
def test_query_equals_sql(spark, database, name):
    found = entry.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = database.execute(entry.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(tuple(row[at] for at in order) for row in expected.fetchall())
    assert sorted(tuple(row) for row in found.select(*columns).collect()) == want


def test_flagship(spark):
    assert entry.entry(spark).columns == ["author", "term", "tf", "df", "tf_idf"]
