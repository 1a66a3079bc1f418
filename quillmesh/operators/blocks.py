"""Sorted lists per key, cut into blocks of bounded length.

A list that grows with the data (the documents of a common word, the
neighbours of a hub) is never gathered in one task. Items are ranked within
their key by item order, and block ``b`` holds ranks ``b * size`` up to
``(b + 1) * size``: the blocks of a key, one after the other, are its list.
Keys with no more than ``size`` items have the one block 0. ``list_blocks`` ranks
rows; ``cut_lists`` starts from lists of each key's items in a range, so that a
row that travels is a list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import keep
from .skew import lookup_join

RANGE = "_range"
BLOCK_SIZE = 10_000
LONG = 100_000
AT = "_at"
MIN_RANGES = 64
MAX_RANGES = 1024
_SAMPLES_PER_RANGE = 32


def item_splits(items: DataFrame, ranges: int | None = None, least: int = 1) -> list:
    """Up to ``ranges - 1`` values cutting the one-column ``items`` evenly.

    As many ranges as shuffle partitions by default, within limits, but no more
    than leave each ``least`` items or each core two. The splits
    come from a random sample of about _SAMPLES_PER_RANGE items per range, of
    which a partition sends fewer the more partitions there are. They steer only
    how the ranking is spread over tasks, never what comes out.
    """
    name = items.columns[0]
    held = items.where(F.col(name).isNotNull())
    rows = held.agg(F.count("*")).first()[0]
    if ranges is None:
        spark = items.sparkSession
        ranges = max(MIN_RANGES, min(MAX_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        ranges = min(ranges, max(2 * spark.sparkContext.defaultParallelism, rows // least))
    share = min(1.0, ranges * _SAMPLES_PER_RANGE / max(1, rows))
    values = sorted(row[0] for row in held.sample(share, 7).collect())
    step = max(1, len(values) // ranges)
    return sorted(set(values[step::step]))[: ranges - 1]


def with_range(rows: DataFrame, item: str, splits: list) -> DataFrame:
    """Add RANGE, the number of splits not above the item, found by halving; nulls come first."""
    if not splits:
        return rows.withColumn(RANGE, F.lit(0))

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return (
            f"CASE WHEN `{item}` < _splits[{middle}] THEN {search(low, middle)} "
            f"ELSE {search(middle + 1, high)} END"
        )

    # The indexed literal folds to plain constants.
    held = rows.withColumn("_splits", F.lit(splits))
    found = F.when(F.col(item).isNull(), 0).otherwise(F.expr(search(0, len(splits))))
    return held.withColumn(RANGE, found).drop("_splits")


def list_blocks(rows: DataFrame, key: str, item: str, splits: Callable[[], list], values: tuple = (),
                total: str | None = None, size: int = BLOCK_SIZE) -> DataFrame:
    """(key, block, n_items[, total], items) from unique (key, item) rows.

    The rows are written once and the items of each key counted. Keys with one
    block, nearly all of them, are collected straight by one aggregate; only the
    others are ranked. ``splits`` gives the ranges of items for that.
    """
    rows = keep(rows, "items")
    counted = [F.count("*").alias("n_items")] + ([F.sum(total).alias("total")] if total is not None else [])
    heads = ["n_items"] + (["total"] if total is not None else [])
    listed = F.sort_array(F.collect_list(F.struct(item, *values))).alias("items")
    columns = [key, "block", *heads, "items"]
    long = keep(rows.groupBy(key).agg(*counted).where(F.col("n_items") > size), "long")
    sizes = long.select(key, F.col("n_items").alias("_rows"))
    if long.isEmpty():
        short = rows
    else:
        short = lookup_join(rows, long.select(key), key, "left_anti", counts=sizes)
    blocks = short.groupBy(key).agg(*counted, listed).withColumn("block", F.lit(0).cast("bigint")).select(*columns)
    if long.isEmpty():
        return blocks
    ranked = _ranked(with_range(lookup_join(rows, long, key, counts=sizes), item, splits()), key, item)
    block = F.floor((F.col("_rank") - 1) / F.lit(size)).cast("bigint").alias("block")
    ranked = ranked.groupBy(key, block).agg(*(F.first(h).alias(h) for h in heads), listed)
    return blocks.unionByName(ranked.select(*columns))


def cut_lists(lists: DataFrame, key: str, size: int = BLOCK_SIZE) -> DataFrame:
    """(key, block, n_items, total, items) from (key, AT, n, sum, items) rows.

    The n items of a row are sorted, and come before those of its key with a higher
    AT. Keys of up to LONG items, or of one block, are put together and cut as one
    row. Of the others, where a row stands in its key's list follows from the n of
    the rows before, which are counted without the items; it is cut where a block ends.
    """
    lists = keep(lists, "lists")
    counts = lists.groupBy(key).agg(F.sum("n").alias("n_items"), F.sum("sum").alias("total"), F.count("*").alias("_rows"))
    long = keep(counts.where(F.col("n_items") > max(size, LONG)), "long")
    none = long.isEmpty()
    sizes = long.select(key, "_rows")
    short = lists if none else lookup_join(lists, long.select(key), key, "left_anti", counts=sizes)
    gathered = short.groupBy(key).agg(
        F.sum("n").alias("n_items"), F.sum("sum").alias("total"),
        F.flatten(F.sort_array(F.collect_list(F.struct(AT, "items")))["items"]).alias("items"))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_items") - 1) / F.lit(size)).cast("bigint"))
    cut = F.transform(blocks, lambda block: F.struct(block.alias("block"), F.slice(
        "items", (block * size + 1).cast("int"), F.lit(size)).alias("items")))
    gathered = gathered.select(key, "n_items", "total", F.explode(cut).alias("_part"))
    gathered = gathered.select(key, "_part.block", "n_items", "total", "_part.items")
    if none:
        return gathered
    whole = Window.partitionBy("_key").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    rest = lookup_join(lists, long.drop("_rows"), key, counts=sizes)
    places = lookup_join(lists.select(key, AT, "n"), long.select(key), key, "left_semi", counts=sizes).select(
        F.col(key).alias("_key"), F.col(AT).alias("_place"), "n").select(
        "_key", "_place", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("_before"))
    placed = rest.join(places.hint("merge"), (F.col(key) == F.col("_key")) & (F.col(AT) == F.col("_place")))

    def part(block):
        begin = block * size - F.col("_before")
        start = F.greatest(begin, F.lit(0).cast("bigint"))
        items = F.slice("items", (start + 1).cast("int"), (begin + size - start).cast("int"))
        return F.struct(block.alias("block"), items.alias("items"))

    blocks = F.sequence(*(F.floor(rank / F.lit(size)).cast("bigint")
                          for rank in (F.col("_before"), F.col("_before") + F.col("n") - 1)))
    parts = placed.select(key, AT, "n_items", "total", F.explode(F.transform(blocks, part)).alias("_part"))
    parts = parts.select(key, "_part.block", "n_items", "total", F.struct(AT, "_part.items").alias("_part"))
    return gathered.unionByName(parts.groupBy(key, "block").agg(
        F.first("n_items").alias("n_items"), F.first("total").alias("total"),
        F.flatten(F.sort_array(F.collect_list("_part"))["items"]).alias("items")))


def _ranked(rows: DataFrame, key: str, item: str) -> DataFrame:
    """Add _rank, from 1, within each key.

    Ranks are counted within (key, range), so even a key with every row is ranked
    by many tasks; the counts of a key's earlier ranges, at most MAX_RANGES rows,
    shift them.
    """
    within = Window.partitionBy(key, RANGE).orderBy(item)
    earlier = Window.partitionBy(key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(key, RANGE).agg(F.count("*").alias("_rows")).select(
        key, RANGE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    ranked = rows.withColumn("_rank", F.row_number().over(within)).join(offsets.hint("merge"), [key, RANGE])
    return ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
