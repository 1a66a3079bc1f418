"""Neighbourhood component analysis: probabilities, gradient, training, k-NN.

Each comes in two forms: from samples (id, x), over all pairs of them, and
from a given table of pairs (i, j, x).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import pairs as pair_ops
from ..operators import samples as sample_ops
from ..operators.skew import is_small
from ..sources.matrices import holds_model, last_epoch, load_model, save_epoch
from ..sources.scratch import keep


def sample_success(samples: DataFrame, labels: DataFrame, matrix=None) -> DataFrame:
    """(id, p): chance that a sample picks a neighbour of its own label."""
    rows, n, d = sample_ops.labelled_samples(samples, labels)
    matrix, blocks = _start(matrix, d), sample_ops.block_count(rows, n, d)
    sums = sample_ops.kernel_sums(rows, matrix, blocks, sample_ops.kernel_balls(rows, matrix, blocks))
    return sample_ops.success(sums).select("id", "p")


def expected_correct(successes: DataFrame) -> DataFrame:
    """One row, f: expected number of rightly classified samples."""
    return successes.agg(F.coalesce(F.sum("p"), F.lit(0.0)).alias("f"))


def nca_gradient(samples: DataFrame, labels: DataFrame, matrix=None) -> DataFrame:
    """(r, c, v) of the ascent direction at ``matrix``."""
    rows, n, d = sample_ops.labelled_samples(samples, labels)
    return _sample_gradient(rows, sample_ops.block_count(rows, n, d))(_start(matrix, d))


def nca_fit(samples: DataFrame, labels: DataFrame, lr: float, epochs: int,
            tol: float | None = None, matrix=None,
            each: Callable[[np.ndarray], None] | None = None) -> list:
    """Matrices by epoch, [0] being the start (the identity by default).

    Ends early once no entry of A moves by ``tol`` or more. ``each`` is given A
    after every epoch. Only A, d x d numbers, comes to the driver; the plan of
    an epoch never grows.
    """
    rows, n, d = sample_ops.labelled_samples(samples, labels)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _ascend(_sample_gradient(rows, sample_ops.block_count(rows, n, d)),
                       _start(matrix, d), lr, epochs, tol, each)
    finally:
        rows.unpersist()


def nca_fit_stored(samples: DataFrame, labels: DataFrame, lr: float, epochs: int, path: str,
                   matrix=None) -> DataFrame:
    """(epoch, r, c, v, f) of epochs 0 to ``epochs``, kept at ``path``; f is the expected success at A.

    Every epoch is stored before the next one starts. A fit that was broken off,
    or is wanted longer, goes on from the last epoch that is stored.
    """
    spark = samples.sparkSession
    rows, n, d = sample_ops.labelled_samples(samples, labels)
    blocks = sample_ops.block_count(rows, n, d)

    def successes_at(a):
        balls = sample_ops.kernel_balls(rows, a, blocks)
        found = keep(sample_ops.success(sample_ops.kernel_sums(rows, a, blocks, balls)), "success")
        return found, balls, expected_correct(found).first().f

    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    found = None
    try:
        if holds_model(spark, path):
            epoch = last_epoch(spark, path)
            a = load_model(spark, path, epoch)
        else:
            epoch, a = 0, _start(matrix, d)
            found, balls, f = successes_at(a)
            save_epoch(spark, 0, a, path, success=f)
        while epoch < epochs:
            if found is None:
                found, balls, _ = successes_at(a)
            step = _collected(sample_ops.gradient(rows, found, a, blocks, balls), a.shape)
            epoch, a = epoch + 1, a + lr * step
            found, balls, f = successes_at(a)
            save_epoch(spark, epoch, a, path, success=f)
    finally:
        rows.unpersist()
    return spark.read.parquet(path).where(F.col("epoch") <= epochs)


def pair_success(pairs: DataFrame, labels: DataFrame, matrix) -> DataFrame:
    """(i, p) over the given pairs."""
    kernels = pair_ops.pair_kernels(pair_ops.with_pair_labels(pairs, labels), matrix).drop("x")
    return pair_ops.pair_success(pair_ops.pair_probabilities(kernels, pairs))


def pair_probabilities(pairs: DataFrame, matrix) -> DataFrame:
    """(i, j, p) over the given pairs."""
    kernels = pair_ops.pair_kernels(pairs, matrix).drop("x")
    return pair_ops.pair_probabilities(kernels, pairs).select("i", "j", "p")


def nca_fit_pairs(pairs: DataFrame, labels: DataFrame, dim: int, lr: float, epochs: int,
                  tol: float | None = None, matrix=None,
                  each: Callable[[np.ndarray], None] | None = None) -> list:
    """As ``nca_fit``, over the given pairs.

    Pairs are labelled, counted and written once; an epoch reads them.
    """
    stored = keep(pair_ops.with_pair_labels(pairs, labels), "pairs")
    counts = keep(pair_ops.row_counts(stored), "rows")
    small = is_small(counts)
    return _ascend(lambda a: pair_ops.labelled_gradient(stored, counts, small, a),
                   _start(matrix, dim), lr, epochs, tol, each)


def knn_predict(samples: DataFrame, labels: DataFrame, k: int, matrix=None) -> DataFrame:
    """(id, predicted): majority label of the k nearest other samples.

    Distances count to 9 digits, then the smaller id; votes tie to the smaller
    label.
    """
    rows, n, d = sample_ops.labelled_samples(samples, labels)
    return _voted(sample_ops.nearest(rows, _start(matrix, d), sample_ops.block_count(rows, n, d), k), k)


def knn_predict_for(queries: DataFrame, samples: DataFrame, labels: DataFrame, k: int, matrix=None) -> DataFrame:
    """(id, predicted) for (id, x) queries: majority label of the k nearest samples, as in ``knn_predict``.

    A query is compared with a sample of its own id too.
    """
    rows, n, d = sample_ops.labelled_samples(samples, labels)
    return _voted(sample_ops.nearest_of(queries, rows, _start(matrix, d), sample_ops.block_count(rows, n, d), k), k)


def _voted(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    votes = (
        found.withColumn("_at", F.row_number().over(order))
        .where(F.col("_at") <= k)
        .groupBy("id", "label")
        .agg(F.count("*").alias("_votes"))
    )
    best = F.min(F.struct(-F.col("_votes"), "label"))["label"]
    return votes.groupBy("id").agg(best.alias("predicted"))


def _start(matrix, d: int) -> np.ndarray:
    return np.eye(d) if matrix is None else np.asarray(matrix, dtype=float)


def _sample_gradient(rows: DataFrame, blocks: int) -> Callable[[np.ndarray], DataFrame]:
    def gradient(a: np.ndarray) -> DataFrame:
        balls = sample_ops.kernel_balls(rows, a, blocks)
        successes = sample_ops.success(sample_ops.kernel_sums(rows, a, blocks, balls))
        return sample_ops.gradient(rows, successes, a, blocks, balls)

    return gradient


def _ascend(gradient: Callable[[np.ndarray], DataFrame], a: np.ndarray, lr: float,
            epochs: int, tol: float | None, each) -> list:
    history = [a]
    for _ in range(epochs):
        step = lr * _collected(gradient(a), a.shape)
        a = a + step
        history.append(a)
        if each is not None:
            each(a)
        if tol is not None and np.abs(step).max() < tol:
            break
    return history


def _collected(entries: DataFrame, shape: tuple) -> np.ndarray:
    matrix = np.zeros(shape)
    for row in entries.collect():
        matrix[row.r, row.c] = row.v
    return matrix
