"""Matrix-valued data sets as Parquet, and the learned matrix per epoch."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL_SCHEMA = "epoch INT, r INT, c INT, v DOUBLE"


def write_keyed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """(i, j, x), (i, x) or long (i, j, r, c, v) rows between jobs."""
    df.write.mode(mode).parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def model_frame(spark: SparkSession, history: list) -> DataFrame:
    """(epoch, r, c, v) rows of the matrices, epoch 0 being the start."""
    rows = [
        (epoch, r, c, float(v))
        for epoch, matrix in enumerate(history)
        for (r, c), v in np.ndenumerate(np.asarray(matrix))
    ]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def save_model(spark: SparkSession, history: list, path: str, mode: str = "overwrite") -> None:
    model_frame(spark, history).write.mode(mode).parquet(path)


def save_epoch(spark: SparkSession, epoch: int, matrix, path: str, mode: str = "append",
               success: float | None = None) -> None:
    """Add the matrix of one epoch to a model, in one file: all of it or nothing.

    ``success``, if given, goes along as column f.
    """
    rows = model_frame(spark, [matrix]).withColumn("epoch", F.lit(epoch))
    if success is not None:
        rows = rows.withColumn("f", F.lit(float(success)))
    rows.coalesce(1).write.mode(mode).parquet(path)


def last_epoch(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).agg(F.max("epoch")).first()[0]


def holds_model(spark: SparkSession, path: str) -> bool:
    """Whether an epoch was saved at the path."""
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*.parquet")
    return bool(files.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(files))


def load_model(spark: SparkSession, path: str, epoch: int | None = None) -> np.ndarray:
    """The matrix of one epoch, the last by default; d x d numbers."""
    stored = spark.read.parquet(path)
    if epoch is None:
        epoch = last_epoch(spark, path)
    rows = stored.where(F.col("epoch") == epoch).collect()
    matrix = np.zeros((1 + max(r.r for r in rows), 1 + max(r.c for r in rows)))
    for row in rows:
        matrix[row.r, row.c] = row.v
    return matrix
