"""SQL tables over tab-delimited text, without quoting or escapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_delimited_table(spark: SparkSession, name: str, columns: str) -> None:
    """``columns`` as in DDL, such as ``word STRING, count DOUBLE``."""
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING csv "
        "OPTIONS (sep '\\t', quote '', escape '', ignoreLeadingWhiteSpace 'false', "
        "ignoreTrailingWhiteSpace 'false', mode 'FAILFAST')"
    )


def read_delimited(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    parts = F.split("value", "\t", len(schema))
    return spark.read.text(path).select(
        *(parts[at].cast(field.dataType).alias(field.name) for at, field in enumerate(schema))
    )


def load_delimited(spark: SparkSession, name: str, path) -> None:
    """Append the rows of text files to a table."""
    read_delimited(spark, path, spark.table(name).schema).write.insertInto(name)
