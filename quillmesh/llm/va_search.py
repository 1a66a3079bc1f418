"""Exact top-k by inner product over vector-approximation files.

Components become whole numbers, floor(scale * x). Every dimension is cut into
cells of equal whole width between its least and greatest value, and a table
holds the cells of every vector, a byte a component: the approximation file.

Only that file meets the queries, in blocks dealt to a grid. A vector's cells
bound its score from above and below, and what a block cannot rule out by its
own k-th lower bound leaves it. One bound per query over all blocks rules out
more. Then exact vectors are read in the order of their upper bounds: the first
k, and of the rest those whose bound the k-th exact score does not beat.

Defined cases: null vectors and those holding null or non-finite components
take no part; scores are between vectors of the same length only; ties go to
the smaller id; rows that repeat count as often as they come, and a query never
meets a row with its own id; an empty table gives no rows. Rows without an id
take no part. Columns other than the id and the vector are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep

K = 20
SCALE = 64
CELLS = 64  # of a dimension; up to 256, as a cell is a byte
QUERY_BLOCK = 512
VECTOR_BLOCK = 8192
_EXACT = 2.0 ** 53

_BOUNDS = "query BIGINT, row BIGINT, upper DOUBLE, lower DOUBLE"


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, x): the scaled vectors that take part, as doubles."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    # Rounded down where they are read: floor() gives longs, which may be too short.
    x = F.transform("embedding", lambda v: v.cast("double") * scale)
    return rows.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & good).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.size("embedding").alias("dim"), x.alias("x"))


def top_k(rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, cells: int = CELLS,
          query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows per query.

    ``rows`` hold vec_id and embedding; ``is_query``, over vec_id, tells the queries.
    """
    vectors = whole_vectors(rows.select("vec_id", "embedding"), scale).where("dim > 0")
    vectors = keep(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = vectors.where(is_query)
    bounds = keep(_bounds(vectors, queries, k, cells, query_block, vector_block), "bounds")

    # What one bound per query, the k-th lower one of all blocks, does not rule out.
    best = Window.partitionBy("query").orderBy(F.desc("lower"))
    least = bounds.select("query", "lower").withColumn("_at", F.row_number().over(best)).where(
        F.col("_at") <= k).groupBy("query").agg(F.when(F.count("*") == k, F.min("lower")).alias("least"))
    left = lookup_join(bounds.drop("lower"), keep(least, "least"), "query").where(
        "least IS NULL OR upper >= least").drop("least")

    # Exact vectors in the order of their bounds, until the k-th is certain.
    order = Window.partitionBy("query").orderBy(F.desc("upper"), "row")
    first = keep(left.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k), "first")
    read = keep(exact_scores(first.select("query", "row"), vectors), "read")
    certain = read.groupBy("query").agg(F.when(F.count("*") == k, F.min("score")).alias("certain"))
    after = first.groupBy("query").agg(F.max(F.struct("_at", "upper", (-F.col("row")).alias("row"))).alias("last"))
    rest = lookup_join(left, keep(certain.join(after, "query"), "certain"), "query").where(
        "struct(-upper, row) > struct(-last.upper, -last.row) AND upper >= certain").select("query", "row")
    found = read.unionByName(exact_scores(keep(rest, "rest"), vectors))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def approximation(vectors: DataFrame, ranges: dict, cells: int) -> DataFrame:
    """(row, vec_id, dim, cells): the cell of each component as a byte."""
    def cut(batches):
        for batch in batches:
            found = [None] * batch.num_rows
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                low, _, width = _cut(*ranges[int(dim)], cells)
                at = np.flatnonzero(dims == dim)
                x = batch.column("x").take(pa.array(at)).flatten().to_numpy().reshape(-1, dim)
                cell = np.clip(np.floor((np.floor(x) - low) / width), 0, cells - 1).astype(np.uint8)
                for i, row in zip(at, cell):
                    found[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "vec_id", "dim")), pa.array(found, pa.binary())],
                names=["row", "vec_id", "dim", "cells"])

    return vectors.mapInArrow(cut, "row BIGINT, vec_id BIGINT, dim INT, cells BINARY")


def _cut(low, high, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least and greatest value and the width of a cell, of each dimension."""
    low, high = np.asarray(low), np.asarray(high)
    return low, high, np.maximum(np.ceil((high - low + 1) / cells), 1.0)


def _bounds(vectors: DataFrame, queries: DataFrame, k: int, cells: int, query_block: int,
            vector_block: int) -> DataFrame:
    """(query, row, upper, lower) of what no block rules out by itself; query and row tell rows."""
    ranges = {r.dim: (r.low, r.high) for r in _ranges(vectors).collect()}
    file = keep(approximation(vectors, ranges, cells), "cells")
    # A block of either side goes to a row or a column of the grid, not to every other block.
    side = math.ceil(math.sqrt(4 * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    own = _blocks(queries.select("row", "vec_id", "dim", "x"), query_block).select(
        "dim", F.col("rows").alias("asked"), F.pmod("block", F.lit(side)).alias("_row"),
        F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias("_column"))
    held = _blocks(file, vector_block).select(
        "dim", "rows", F.pmod("block", F.lit(side)).alias("_column"),
        F.explode(F.sequence(F.lit(0), F.lit(side - 1))).alias("_row"))
    met = own.join(held, ["dim", "_row", "_column"]).select("dim", "asked", "rows")

    def scan(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                dim = batch.column("dim")[at].as_py()
                asked, rows = (batch.column(c)[at].values for c in ("asked", "rows"))
                q = np.floor(asked.field("x").flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)
                cell = np.frombuffer(b"".join(rows.field("cells").to_pylist()), dtype=np.uint8).reshape(-1, dim)
                ids = [side.field(c).to_numpy() for side in (asked, rows) for c in ("row", "vec_id")]
                yield _scan(*ids, q, cell, _cut(*ranges[dim], cells), k)

    return met.mapInArrow(scan, _BOUNDS)


def exact_scores(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query, query_id, vec_id, score) of (query, row) pairs, off the exact vectors."""
    for key, name in (("query", "q"), ("row", "v")):
        side = vectors.select(F.col("row").alias(key), F.struct("vec_id", "x").alias(name))
        pairs = lookup_join(pairs, side, key, small=False)

    def multiply(batches):
        for batch in batches:
            scores = []
            for q, v in zip(batch.column("q").field("x"), batch.column("v").field("x")):
                q, v = (np.floor(x.values.to_numpy()) for x in (q, v))
                exact = np.abs(q).max() * np.abs(v).max() * len(q) < _EXACT
                scores.append(int(q @ v) if exact else sum(int(a) * int(b) for a, b in zip(q, v)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("q").field("vec_id"), batch.column("v").field("vec_id"),
                 pa.array(scores, pa.int64())], names=["query", "query_id", "vec_id", "score"])

    return pairs.mapInArrow(multiply, "query BIGINT, query_id BIGINT, vec_id BIGINT, score BIGINT")


def _ranges(vectors: DataFrame) -> DataFrame:
    """(dim, low, high): the least and greatest value of each component."""
    def extremes(batches):
        seen = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                x = batch.filter(pa.array(dims == dim)).column("x").flatten().to_numpy().reshape(-1, dim)
                x = np.floor(x)
                low, high = x.min(axis=0), x.max(axis=0)
                if dim in seen:
                    low, high = np.minimum(low, seen[dim][0]), np.maximum(high, seen[dim][1])
                seen[dim] = (low, high)
        for dim, (low, high) in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([low.tolist()]), pa.array([high.tolist()])],
                names=["dim", "low", "high"])

    parts = vectors.where("dim > 0").mapInArrow(extremes, "dim INT, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>")
    each = parts.select("dim", F.posexplode(F.arrays_zip("low", "high")).alias("at", "pair"))
    each = each.groupBy("dim", "at").agg(F.min("pair.low").alias("low"), F.max("pair.high").alias("high"))
    both = each.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("at", "low", "high"))).alias("all"))
    return both.select("dim", "all.low", "all.high")


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(dim, block, rows) with about ``size`` rows each, dealt by a hash of the row."""
    numbers = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).alias("_blocks"))
    dealt = lookup_join(rows, keep(numbers, "blocks"), "dim")
    held = [c for c in rows.columns if c != "dim"]
    return dealt.groupBy("dim", F.pmod(F.xxhash64("row"), "_blocks").alias("block")).agg(
        F.collect_list(F.struct(*held)).alias("rows"))


def _scan(query, query_ids, row, vec_ids, q, cell, cut, k):
    """Bounds of what a block of cells may add to the k best of each query."""
    low, high, width = cut
    below = low + cell * width
    above = np.minimum(below + width - 1, high)
    slack = np.abs(q).max(initial=0) * max(np.abs(low).max(), np.abs(high).max()) * q.shape[1]
    slack = slack * 1e-12 if slack >= _EXACT else 0.0  # rounding of the sums below
    middle, spread = q @ ((above + below) / 2).T, slack
    if (width > 1).any():
        spread = spread + np.abs(q) @ ((above - below) / 2).T
    upper, lower = middle + spread, middle - spread
    own = query_ids[:, None] == vec_ids
    upper[own] = lower[own] = -np.inf
    if k < len(row):
        # The k-th lower bound; -inf, which only a vector's own id has, rules nothing out.
        least = np.partition(lower, len(row) - k, axis=1)[:, len(row) - k, None]
    else:
        least = -np.inf
    i, j = ((upper >= least) & ~own).nonzero()
    return pa.RecordBatch.from_arrays(
        [pa.array(query[i]), pa.array(row[j]), pa.array(upper[i, j]), pa.array(lower[i, j])],
        names=["query", "row", "upper", "lower"])
