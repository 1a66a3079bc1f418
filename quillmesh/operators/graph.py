"""Edges, degrees, adjacency and triangles over (src, dst) rows."""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep
from .blocks import BLOCK_SIZE, item_splits, list_blocks
from .skew import lookup_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODES = ("undirected", "directed")
TASK_EDGES = 1 << 20
MIN_COLOURS = 3
WEDGES = 1 << 20
LIGHT = 128  # edges of a vertex that sends its heads to each other
TASK_WEDGES = 1 << 22
DEALT = 1 << 14  # edges of a middle to a task


def simple_edges(edges: DataFrame, mode: str = "undirected") -> DataFrame:
    """Distinct (lo, hi) vertex pairs with lo < hi and no self-loops.

    ``undirected`` takes an edge in either direction, ``directed`` only a pair
    joined in both. Repeated input edges count once in either mode.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    ends = edges.where("src <> dst").select(
        F.least("src", "dst").alias("lo"),
        F.greatest("src", "dst").alias("hi"),
        (F.col("src") < F.col("dst")).alias("up"),
    )
    # Said out loud, so that no later join adds it on one side only: equal plans
    # share one shuffle.
    ends = ends.where("lo IS NOT NULL AND hi IS NOT NULL")
    if mode == "undirected":
        return ends.select("lo", "hi").distinct()
    return (
        ends.groupBy("lo", "hi")
        .agg(F.bool_or("up").alias("up"), F.bool_or(~F.col("up")).alias("down"))
        .where("up and down")
        .select("lo", "hi")
    )


def both_directions(lines: DataFrame) -> DataFrame:
    """(vertex, neighbour) rows, two per (lo, hi) pair."""
    pair = F.explode(
        F.array(
            F.struct(F.col("lo").alias("vertex"), F.col("hi").alias("neighbour")),
            F.struct(F.col("hi").alias("vertex"), F.col("lo").alias("neighbour")),
        )
    )
    return lines.select(pair.alias("pair")).select("pair.vertex", "pair.neighbour")


def adjacency_blocks(edges: DataFrame, mode: str = "undirected",
                     size: int = BLOCK_SIZE, ranges: int | None = None) -> DataFrame:
    """(vertex, block, degree, neighbours), neighbours sorted and distinct."""
    lines = simple_edges(edges, mode)
    # Both ends are neighbours of something, so both give splits.
    ends = edges.select(F.explode(F.array("src", "dst")).alias("neighbour"))
    blocks = list_blocks(both_directions(lines), "vertex", "neighbour", lambda: item_splits(ends, ranges), size=size)
    return blocks.select(
        "vertex",
        "block",
        F.col("n_items").alias("degree"),
        F.col("items.neighbour").alias("neighbours"),
    )


def degrees(lines: DataFrame) -> DataFrame:
    ends = lines.select(F.explode(F.array("lo", "hi")).alias("vertex"))
    return (
        ends.where("vertex IS NOT NULL")
        .groupBy("vertex")
        .agg(F.count("*").alias("degree"))
    )


def count_triangles(edges: DataFrame, mode: str = "undirected", colours: int | None = None,
                    light: int = LIGHT) -> DataFrame:
    """One row, n. Each triangle is met once.

    Edges point to the end with more edges. A triangle is looked for at the vertex
    that two of its edges leave. If that one has ``light`` edges at most, its
    heads meet the edges among them, see ``_light``: that is ``light`` / 2 numbers
    to an edge, however many there are. The others lie among the vertices with more
    edges than that, and are counted in tasks of three colours, see ``_coloured``.
    """
    lines = keep(simple_edges(edges, mode), "lines")
    ends = keep(degrees(lines).withColumnRenamed("degree", "_rows"), "ends")
    for end in ("lo", "hi"):
        own = ends.withColumnRenamed("vertex", end)
        lines = lookup_join(lines, own.withColumnRenamed("_rows", f"_{end}"), end, counts=own)
    up = F.struct("_lo", "lo") < F.struct("_hi", "hi")
    turned = keep(lines.select(
        F.when(up, F.col("lo")).otherwise(F.col("hi")).alias("tail"),
        F.when(up, F.col("hi")).otherwise(F.col("lo")).alias("head"),
        F.least("_lo", "_hi").alias("low"), F.greatest("_lo", "_hi").alias("high")), "turned")
    found = _light(turned, ends, light).unionByName(_coloured(turned.where(F.col("low") > light), colours))
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def _light(turned: DataFrame, ends: DataFrame, light: int) -> DataFrame:
    """(n) by task: triangles that two edges of a vertex with ``light`` edges at most leave.

    A light vertex sends each of its heads, the middle, those that come after it,
    and they are looked up among the heads of the middle. Tasks are bounded: they
    grow in number with what is sent, and a middle with many edges is dealt to
    several, which have its heads each.
    """
    spark = turned.sparkSession
    lists = turned.where(F.col("low") <= light).groupBy("tail").agg(
        F.sort_array(F.collect_list(F.struct("high", "head"))).alias("heads"))
    lists = keep(lists.where("size(heads) > 1"), "lists")
    middles = lists.select(F.explode(F.expr("slice(heads, 1, size(heads) - 1).head")).alias("tail")).distinct()
    closing = lookup_join(turned, keep(middles, "middles"), "tail", counts=ends.withColumnRenamed("vertex", "tail"))
    parts = f"CAST(ceil({{}} / {DEALT}) AS BIGINT)"
    closing = closing.select(
        F.col("tail").alias("middle"), F.explode(F.expr(f"sequence(0L, {parts.format('low')} - 1)")).alias("part"),
        F.lit(True).alias("closing"), F.array("head").alias("ends"))
    sent = F.expr(
        "transform(sequence(1, size(heads) - 1), i -> named_struct('middle', heads[i - 1].head, "
        f"'part', pmod(xxhash64(tail), {parts.format('heads[i - 1].high')}), "
        "'closing', false, 'ends', slice(heads, i + 1, size(heads) - i).head))")
    numbers = lists.agg(F.sum(F.expr("size(heads) * (size(heads) - 1L) div 2"))).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(numbers / TASK_WEDGES))
    met = closing.unionByName(lists.select(F.explode(sent).alias("sent")).select("sent.*"))
    return met.repartition(tasks, "middle", "part").select("middle", "closing", "ends").mapInArrow(_closed, "n BIGINT")


def _closed(batches):
    """How many of the pairs of a middle and an end are edges."""
    edges, sent = [], []
    for batch in batches:
        closing = batch.column("closing")
        edges.append(batch.filter(closing))
        sent.append(batch.filter(pc.invert(closing)))
    edges = pa.Table.from_batches(edges) if edges else None
    if edges is None or not len(edges):
        return
    tails, heads = (pa.chunked_array(c).combine_chunks().dictionary_encode() for c in (
        edges.column("middle").chunks, [pc.list_flatten(c) for c in edges.column("ends").chunks]))
    width = len(heads.dictionary)
    names = np.sort(tails.indices.to_numpy().astype(np.int64) * width + heads.indices.to_numpy())
    found = 0
    for batch in sent:
        middle = pc.fill_null(pc.index_in(batch.column("middle"), tails.dictionary), -1).to_numpy().astype(np.int64)
        ends = batch.column("ends")
        middle = middle[pc.list_parent_indices(ends).to_numpy()]
        end = pc.fill_null(pc.index_in(pc.list_flatten(ends), heads.dictionary), -1).to_numpy()
        known = (middle >= 0) & (end >= 0)
        wanted = middle[known] * width + end[known]
        place = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        found += int((names[place] == wanted).sum())
    yield pa.RecordBatch.from_pydict({"n": pa.array([found], pa.int64())})


def _coloured(lines: DataFrame, colours: int | None) -> DataFrame:
    """(n) by task of the triangles of distinct (tail, head) edges.

    Vertices get colours by a hash, and every three of them, repeats included, are
    a task. An edge goes to all tasks that have the colours of its ends, which are
    as many as there are colours, so no list of neighbours and no pair of them
    travels, and a hub's edges are dealt to many tasks. Colours grow with the root
    of the edges, so that a task holds about TASK_EDGES of them.
    """
    if colours is None:
        colours = colour_count(lines.agg(F.count("*")).first()[0])
    lines = lines.select(F.col("tail").alias("lo"), F.col("head").alias("hi"))
    own = [F.pmod(F.xxhash64(end), F.lit(colours)) for end in ("lo", "hi")]
    third = F.explode(F.expr(f"sequence(0L, {colours - 1}L)"))
    dealt = lines.select("lo", "hi", own[0].alias("_a"), own[1].alias("_b"), third.alias("_c"))
    dealt = dealt.select("lo", "hi", (F.col("_a") * colours + F.col("_b")).alias("ends"), F.expr(
        "aggregate(array_sort(array(_a, _b, _c)), 0L, (code, colour) -> code * "
        f"{colours} + colour)").alias("task"))
    return dealt.groupBy("task").applyInArrow(_counted(colours), "n BIGINT")


def colour_count(edges: int) -> int:
    """So many that a task, which has about 6 / colours^2 of all edges, holds TASK_EDGES."""
    return max(MIN_COLOURS, math.ceil(math.sqrt(6 * edges / TASK_EDGES)))


def _counted(colours: int):
    def count(key, table):
        """Triangles of a task's edges that have exactly its colours."""
        table = table.combine_chunks()
        both = pa.chunked_array([*table.column("lo").chunks, *table.column("hi").chunks]).combine_chunks()
        codes = both.dictionary_encode().indices.to_numpy()
        ends = np.concatenate(np.divmod(table.column("ends").to_numpy(), colours))
        task = [key[0].as_py() // colours ** at % colours for at in range(3)]
        # A digit for each colour of the task tells how often a triangle has it.
        digit = np.zeros(colours, dtype=np.int64)
        digit[sorted(set(task))] = 4 ** np.arange(len(set(task)))
        weights = np.zeros(codes.max() + 1, dtype=np.int64)
        weights[codes] = digit[ends]
        found = triangles(codes[:len(table)], codes[len(table):], weights, int(digit[task].sum()))
        return pa.table({"n": pa.array([found], pa.int64())})

    return count


def triangles(a: np.ndarray, b: np.ndarray, weights: np.ndarray, total: int) -> int:
    """Triangles among distinct edges of numbered vertices whose weights add up to ``total``.

    Edges point to the end with more edges, so no vertex is the tail of more than
    the root of twice all. The heads of an edge's head are looked up among those
    of its tail, for as many edges at once as make WEDGES.
    """
    degree = np.bincount(a, minlength=len(weights)) + np.bincount(b, minlength=len(weights))
    rank = np.empty(len(weights), dtype=np.int64)
    rank[np.argsort(degree, kind="stable")] = np.arange(len(weights))
    weights = weights[np.argsort(rank)]
    a, b = rank[a], rank[b]
    names = np.sort(np.minimum(a, b) * len(weights) + np.maximum(a, b))
    tails, heads = np.divmod(names, len(weights))
    starts = np.searchsorted(tails, np.arange(len(weights) + 1))
    sizes = starts[heads + 1] - starts[heads]
    ends = np.cumsum(sizes)
    found, at = 0, 0
    while at < len(names):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + WEDGES, "right")))
        size = sizes[at:to]
        edge = np.repeat(np.arange(at, to), size)
        third = heads[np.arange(len(edge)) - np.repeat(ends[at:to] - size - done, size) + starts[heads[edge]]]
        closing = tails[edge] * len(weights) + third
        place = np.minimum(np.searchsorted(names, closing), len(names) - 1)
        fits = weights[tails[edge]] + weights[heads[edge]] + weights[third] == total
        found += int((fits & (names[place] == closing)).sum())
        at = to
    return found
