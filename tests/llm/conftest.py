import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
