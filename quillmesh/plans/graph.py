"""Adjacency lists and triangle counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph as ops
from ..operators.blocks import BLOCK_SIZE


def adjacency(edges: DataFrame, mode: str = "undirected", size: int = BLOCK_SIZE,
              ranges: int | None = None) -> DataFrame:
    """(vertex, block, degree, neighbours)."""
    return ops.adjacency_blocks(edges, mode, size, ranges)


def adjacency_lines(lists: DataFrame) -> DataFrame:
    """(key, value) text form: ``vertex``, ``n1 n2 ...``."""
    names = F.transform("neighbours", lambda v: v.cast("string"))
    return lists.select(F.col("vertex").alias("key"), F.array_join(names, " ").alias("value"))


def edges_of(lists: DataFrame) -> DataFrame:
    """(src, dst) rows back from (vertex, neighbours) lists."""
    return lists.select(F.col("vertex").alias("src"), F.explode("neighbours").alias("dst"))


def triangle_count(edges: DataFrame, mode: str = "undirected") -> DataFrame:
    """One row, n."""
    return ops.count_triangles(edges, mode)
