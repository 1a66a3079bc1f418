"""Where tables written half way through a job go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A fresh path in ``folder``, which all executors share.

    By default in the folder that spark.checkpoint.dir names, or else in the
    warehouse. What is written there goes when the session ends.
    """
    if not folder:
        folder = spark.conf.get(_SETTING, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    store = own.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(own)
    store.deleteOnExit(own)
    return f"{own}/data"


def keep(rows: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The same rows, written to a scratch table and read back from it.

    Later steps start from the files: the plan stays short, nothing is worked
    out twice, and a lost executor costs no more than its own tasks.
    """
    path = scratch_path(rows.sparkSession, name, folder)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
