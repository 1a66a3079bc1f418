"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep

_MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id of (a, b) links; root is the least id reachable.

    Each round hangs the neighbours of an id under the least of them: first the
    greater ones, then the smaller ones. Only minima and one row per link move,
    so no task ever holds the neighbours of an id, and a round's rows are
    written out, so plans stay short. Ends when a round changes nothing.
    """
    down = _distinct(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    down = keep(down, "links")
    mark = _mark(down)
    for _ in range(_MOST_ROUNDS):
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _distinct(large)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = lowest.select("a", F.col("m").alias("b"))
        down = keep(_distinct(small.unionByName(own)), "links")
        last, mark = mark, _mark(down)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    trees = down.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "id")
    roots = trees.select(F.col("root").alias("id")).distinct()
    return trees.unionByName(roots.withColumn("root", F.col("id")))


def _distinct(links: DataFrame) -> DataFrame:
    return links.where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    """Tells one set of links from another; two numbers per partition travel."""
    code = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(code)).first())


def spanning_links(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: each of n nodes to its least one."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    away = np.flatnonzero(root != np.arange(n))
    return away, root[away]
