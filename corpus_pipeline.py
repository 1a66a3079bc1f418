"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), is written as Parquet and read again
as the documents of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillmesh.llm import line_dedup, mixing, packing, simhash, toxicity  # noqa: E402
from quillmesh.sources.scratch import keep  # noqa: E402

# The stages dedup and mix by hashes and gather models by folds over tasks.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the score puts at 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    taken = {c.lower() for c in docs.columns}
    name = "_toxicity"
    while name in taken:
        name += "_"
    return toxicity.scored(docs, labels, name).where(F.col(name) < 0.5).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that equal or nearly equal an earlier line go; documents stay."""
    return line_dedup.without_repeats(docs, exact_from=1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of fingerprints stays; shingles and radius are those of op9."""
    return simhash.deduplicated(docs, shingle=simhash.SHINGLE, radius=simhash.RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = keep(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return rows

