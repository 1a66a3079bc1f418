"""Text inputs and outputs. A malformed line or number raises (ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import document_name


def read_lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def read_documents(spark: SparkSession, path) -> DataFrame:
    """(doc, text), one row per line, named after the file it stands in."""
    # The metadata column holds the name as in a URL, where a plus is a plus.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(path).select(
        document_name(name).alias("doc"), F.col("value").alias("text")
    )


def read_document_names(spark: SparkSession, path) -> DataFrame:
    """(doc), one row per file; lists the files without reading them."""
    name = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").load(path).select("path")
    return files.select(document_name(name).alias("doc"))


def read_key_values(spark: SparkSession, path) -> DataFrame:
    """(key, value) cut at the first tab; a line without one is all key."""
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        parts[0].alias("key"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("value")
    )


def read_edges(spark: SparkSession, path) -> DataFrame:
    """(src, dst) from ``src dst`` lines; vertex ids stay strings."""
    parts = F.split("value", " ")
    return spark.read.text(path).select(parts[0].alias("src"), parts[1].alias("dst"))


def read_document_list(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("doc"))


def read_labels(spark: SparkSession, path) -> DataFrame:
    """(id, label) from ``id<tab>label`` lines."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(parts[0].alias("id"), parts[1].alias("label"))


def read_pairs(spark: SparkSession, path) -> DataFrame:
    """(i, j, x) from ``i,j<tab>v0 v1 ...`` lines, x = x_i - x_j."""
    ends = F.split("key", ",")
    return read_key_values(spark, path).select(
        ends[0].alias("i"),
        ends[1].alias("j"),
        F.transform(F.split("value", " "), lambda v: v.cast("double")).alias("x"),
    )


def read_adjacency(spark: SparkSession, path) -> DataFrame:
    """(vertex, neighbours) from ``vertex<tab>n1 n2 ...`` lines."""
    return read_key_values(spark, path).select(
        F.col("key").alias("vertex"), F.split("value", " ").alias("neighbours")
    )


def write_key_values(df: DataFrame, path: str, key: Column, value: Column,
                     mode: str = "errorifexists") -> None:
    """``key<tab>value`` lines, nothing quoted."""
    line = F.concat_ws("\t", key.cast("string"), value.cast("string"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_values(df: DataFrame, path: str, value: Column, mode: str = "errorifexists") -> None:
    """One bare value per line."""
    df.select(value.cast("string").alias("value")).write.mode(mode).text(path)


def write_ordered(df: DataFrame, path: str, value: Column, *order: Column,
                  mode: str = "errorifexists") -> None:
    """One bare value per line in the given order: by file name, then by line.

    Rows are dealt by ranges of the order, and files are named by range.
    """
    df.orderBy(*order).select(value.cast("string").alias("value")).write.mode(mode).text(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """(position, value): the lines of all files of a folder, from 1, by file name and line.

    Lines are counted per file split, so no file is read by one task only.
    """
    lines = spark.read.text(path).select(
        "value", F.struct("_metadata.file_name", "_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"))
    splits = lines.groupBy("split").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy().orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    return lines.join(begun.select("split", "begin"), "split").select(
        (F.col("begin") + F.col("at") + 1).alias("position"), "value")
