"""Operators over a table of pairs (i, j, x) with x = x_i - x_j.

The table is taken as it comes: a pair that is not in it counts nowhere.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import divide_or_zero, subtract
from .skew import dealt_in_grid, is_small, lookup_join

# The numpy helpers travel with the tasks, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACKED = "matrix BINARY"


def combine(left: DataFrame, right: DataFrame, keys, value: Column,
            name: str = "v", keep: tuple = ()) -> DataFrame:
    """Inner join of two keyed data sets, then one expression over both sides.

    The expression names its operands ``left.<column>`` and ``right.<column>``.
    Keys may repeat on both sides; those with many rows are dealt in a grid.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    left, right, cell = dealt_in_grid(left, right, keys)
    joined = left.alias("left").join(right.alias("right"), [*keys, *cell])
    return joined.select(*keys, *keep, value.alias(name))


def difference_pairs(samples: DataFrame, links: DataFrame) -> DataFrame:
    """(i, j, x) for the (i, j) rows of ``links``, from (id, x) samples."""
    at_i = samples.select(F.col("id").alias("i"), F.col("x").alias("_xi"))
    at_j = samples.select(F.col("id").alias("j"), F.col("x").alias("_xj"))
    small = is_small(samples)
    both = lookup_join(lookup_join(links, at_i, "i", small=small), at_j, "j", small=small)
    return both.select("i", "j", subtract(F.col("_xi"), F.col("_xj")).alias("x"))


def pair_kernels(pairs: DataFrame, matrix) -> DataFrame:
    """Add k = exp(-|A x|^2), 0 where i = j. A narrow pass, no shuffle."""
    a = _shipped(pairs, matrix)
    schema = pairs.withColumn("k", F.lit(0.0)).schema

    def kernels(batches):
        for batch in batches:
            moved = vectors_of(batch.column("x"), a.value.shape[1]) @ a.value.T
            k = np.exp(-np.einsum("nd,nd->n", moved, moved))
            k[pc.equal(batch.column("i"), batch.column("j")).to_numpy(zero_copy_only=False)] = 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k)], names=schema.names)

    return pairs.mapInArrow(kernels, schema)


def with_pair_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Add same: whether both ends carry one label. A missing or repeated label raises."""
    repeated = F.concat(F.lit("more than one label for sample "), F.col("id"))
    labels = labels.groupBy("id").agg(
        F.when(F.count("*") > 1, F.raise_error(repeated)).otherwise(F.first("label")).alias("label"))
    small = is_small(labels)
    for end in ("i", "j"):
        at_end = labels.select(F.col("id").alias(end), F.col("label").alias(f"_{end}"))
        pairs = lookup_join(pairs, at_end, end, "left", small)
    unlabelled = F.col("_i").isNull() | F.col("_j").isNull()
    message = F.concat(F.lit("no label for a sample of pair "), F.col("i"), F.lit(","), F.col("j"))
    same = F.when(unlabelled, F.raise_error(message)).otherwise(F.col("_i") == F.col("_j"))
    return pairs.withColumn("same", same).drop("_i", "_j")


def row_counts(pairs: DataFrame) -> DataFrame:
    """(i, _rows), read off no other column of the pairs."""
    return pairs.groupBy("i").agg(F.count("*").alias("_rows"))


def with_row_sums(kernels: DataFrame, counts: DataFrame, small: bool, *sums: Column) -> DataFrame:
    """Attach sums over each i to its pairs; the sums combine map-side.

    ``counts`` are the rows of each i and ``small`` tells whether they are few:
    few of them spare the pairs a shuffle, and hot ones are salted.
    """
    totals = kernels.groupBy("i").agg(*sums)
    return lookup_join(kernels, totals, "i", small=small, counts=counts)


def pair_probabilities(kernels: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Add p = k / sum of k over the pairs of i; 0 where k is 0.

    ``pairs`` is the table the kernels came from, if it is at hand.
    """
    counts = row_counts(kernels if pairs is None else pairs)
    summed = with_row_sums(kernels, counts, is_small(counts), F.sum("k").alias("_z"))
    return summed.withColumn("p", divide_or_zero(F.col("k"), F.col("_z"))).drop("_z")


def pair_success(probabilities: DataFrame) -> DataFrame:
    """(i, p): chance that i picks a partner of its own label."""
    own = F.when(F.col("same"), F.col("p")).otherwise(0.0)
    return probabilities.groupBy("i").agg(F.sum(own).alias("p"))


def pair_gradient(pairs: DataFrame, labels: DataFrame, matrix) -> DataFrame:
    """(r, c, v) of A . sum of w x x^T with w = p_ij (p_i - [same label])."""
    counts = row_counts(pairs)
    return labelled_gradient(with_pair_labels(pairs, labels), counts, is_small(counts), matrix)


def labelled_gradient(pairs: DataFrame, counts: DataFrame, small: bool, matrix) -> DataFrame:
    """As ``pair_gradient``, over pairs that carry same, with their row counts.

    A task folds its pairs into one d x d matrix, so no pair ever carries one.
    """
    kernels = pair_kernels(pairs, matrix)
    own = F.when(F.col("same"), F.col("k")).otherwise(0.0)
    summed = with_row_sums(kernels, counts, small, F.sum("k").alias("_z"), F.sum(own).alias("_s"))
    p_pair = divide_or_zero(F.col("k"), F.col("_z"))
    p_row = divide_or_zero(F.col("_s"), F.col("_z"))
    weighted = summed.select("x", (p_pair * (p_row - F.col("same").cast("double"))).alias("w"))
    a = _shipped(pairs, matrix)

    def fold(batches):
        total = np.zeros((a.value.shape[1], a.value.shape[1]))
        for batch in batches:
            x = vectors_of(batch.column("x"), a.value.shape[1])
            w = batch.column("w").to_numpy(zero_copy_only=False)
            total += x.T @ (x * w[:, None])
        yield packed_batch(a.value @ total)

    return summed_matrices(weighted.mapInArrow(fold, PACKED), a.value.shape)


def _shipped(df: DataFrame, matrix):
    return df.sparkSession.sparkContext.broadcast(np.asarray(matrix, dtype=float))


def vectors_of(column, d: int) -> np.ndarray:
    """The vectors of a batch as rows; raises unless all hold ``d`` numbers."""
    flat = column.flatten()
    lengths = pc.list_value_length(column)
    if column.null_count or flat.null_count:
        raise ValueError("a vector or one of its components is null")
    if not pc.all(pc.equal(lengths, d)).as_py() and len(column):
        raise ValueError(f"vectors differ in length from {d}: {sorted(set(lengths.to_pylist()))[:5]}")
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), d)


def packed_batch(matrix: np.ndarray):
    """A matrix as one row, all its numbers in one binary."""
    return pa.RecordBatch.from_arrays([pa.array([matrix.tobytes()], pa.binary())], names=["matrix"])


def summed_matrices(parts: DataFrame, shape: tuple) -> DataFrame:
    """(r, c, v) of the sum of the packed matrices, one row per task of ``parts``.

    Added up in two levels, so no task reads the matrices of all others.
    """
    def total(batches):
        held = np.zeros(shape)
        for batch in batches:
            for packed in batch.column("matrix"):
                held += np.frombuffer(packed.as_buffer(), dtype=float).reshape(shape)
        return held

    def add(batches):
        yield packed_batch(total(batches))

    def unpack(batches):
        yield matrix_batch(total(batches))

    groups = math.ceil(math.sqrt(int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return parts.repartition(groups).mapInArrow(add, PACKED).repartition(1).mapInArrow(
        unpack, "r INT, c INT, v DOUBLE")


def matrix_batch(matrix: np.ndarray):
    r, c = np.indices(matrix.shape)
    return pa.RecordBatch.from_arrays(
        [pa.array(r.ravel(), pa.int32()), pa.array(c.ravel(), pa.int32()), pa.array(matrix.ravel())],
        names=["r", "c", "v"],
    )
