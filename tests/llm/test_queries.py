import duckdb
import pytest

from quillmesh.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = database.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = queries.queries()[name](spark, SF_DIR).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
