"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more rows than a shuffle partition has on average,
# or than 1/MIN_HOT_KEYS of all. So there are no more hot keys than partitions.
MIN_HOT_KEYS = 1000
MIN_SALTS = 64
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def spread(scan: DataFrame) -> DataFrame:
    """Deal rows out when a plain scan has fewer partitions than there are cores.

    Such an input is small (each scan partition is bounded), so the extra
    exchange is too; larger inputs are left as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(2 * cores)


def is_hot(weight: Column, total: Column) -> Column:
    """Whether a key of this weight holds more than the share of a task."""
    partitions = int(SparkSession.active().conf.get("spark.sql.shuffle.partitions"))
    return weight * max(MIN_HOT_KEYS, partitions) > total


def hot_keys(counts: DataFrame, key: str, weight: str) -> DataFrame:
    """The hot keys of a table with one row per key."""
    total = counts.agg(F.sum(weight)).scalar()
    return counts.where(is_hot(F.col(weight), total)).select(key)


def flag_hot(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add _hot to rows; it is null on all but the rows of hot keys."""
    flags = hot.select(F.col(hot.columns[0]).alias(key), F.lit(True).alias("_hot"))
    return rows.join(F.broadcast(flags), key, "left")


def salted_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with a one-row-per-key ``lookup``; both carry _hot.

    Rows of a hot key are dealt over as many tasks as a shuffle has, and only
    the lookup rows of hot keys are copied; other keys are joined as usual.
    """
    salts = max(MIN_SALTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    only = F.array(F.lit(0).cast("bigint"))
    dealt = rows.withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
    copied = lookup.withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(only))
    ).drop("_hot")
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")


def dealt_in_grid(left: DataFrame, right: DataFrame, keys: list) -> tuple[DataFrame, DataFrame, list]:
    """Both sides of an inner join and the further columns to join them on; keys may repeat on both.

    The left rows of a key that is hot on both sides are dealt over the rows of
    a square grid of as many cells as a shuffle has tasks, its right rows over
    the columns, and each goes to all cells of its row or column. A key that is
    hot on one side only has a single row or column.
    """
    conf = left.sparkSession.conf.get("spark.sql.shuffle.partitions")
    salts = max(MIN_SALTS, int(conf))
    side = math.ceil(math.sqrt(salts))
    hot = []
    for rows, mark in ((left, "_left"), (right, "_right")):
        counts = rows.select(F.struct(*keys).alias("_key")).groupBy("_key").agg(F.count("*").alias("_n"))
        hot.append(hot_keys(counts, "_key", "_n").withColumn(mark, F.lit(True)))
    both = hot[0].join(hot[1], "_key", "full")

    def parts(mark, other):
        return F.when(F.col(mark).isNull(), 1).when(F.col(other).isNull(), salts).otherwise(side)

    grid = F.broadcast(both.select("_key", parts("_left", "_right").alias("_rows"),
                                   parts("_right", "_left").alias("_columns")))

    def dealt(rows, own, other, row, column):
        marked = rows.withColumn("_key", F.struct(*keys)).join(grid, "_key", "left").drop("_key")
        own, other = (F.coalesce(F.col(c), F.lit(1)) for c in (own, other))
        salt = F.pmod(F.xxhash64(*rows.columns), own).cast("int")
        return marked.withColumn(row, salt).withColumn(
            column, F.explode(F.sequence(F.lit(0), other - 1))).drop("_rows", "_columns")

    return (dealt(left, "_rows", "_columns", "_row", "_column"),
            dealt(right, "_columns", "_rows", "_column", "_row"), ["_row", "_column"])


def is_small(lookup: DataFrame) -> bool:
    """Whether the rows, counted and weighed, are few enough to broadcast.

    One aggregate: a partition sends two numbers, however many rows it holds.
    """
    weight = sum((_bytes_of(field) for field in lookup.schema), F.lit(0))
    seen = lookup.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(weight), F.lit(0)).alias("bytes")
    ).first()
    return seen["rows"] <= BROADCAST_ROWS and seen["bytes"] <= BROADCAST_BYTES


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                small: bool | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Broadcast the one-row-per-key lookup if it is small, else salt the join.

    ``small`` tells where that is known already. ``counts`` holds (key, _rows),
    the rows of each key, where it comes cheaper than off ``rows``.
    """
    if is_small(lookup) if small is None else small:
        return rows.join(F.broadcast(lookup), key, how)
    if counts is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("_rows"))
    hot = hot_keys(counts, key, "_rows")
    return salted_join(flag_hot(rows, key, hot), flag_hot(lookup, key, hot), key, how)


def _bytes_of(field: T.StructField) -> Column:
    return _weight(F.col(f"`{field.name}`"), field.dataType)


def _weight(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value by its type: what strings, binaries, arrays, maps and structs hold counts too."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("bigint")
    if isinstance(kind, T.StructType):
        return sum((_weight(value.getField(f.name), f.dataType) for f in kind), F.lit(8).cast("bigint"))
    if isinstance(kind, T.ArrayType):
        if _fixed(kind.elementType):
            # A constant times the length; no element is looked at.
            return F.coalesce(F.size(value) * _fixed(kind.elementType), F.lit(0)).cast("bigint")
        total = F.aggregate(value, F.lit(0).cast("bigint"), lambda sum_, v: sum_ + _weight(v, kind.elementType))
        return F.coalesce(total, F.lit(0).cast("bigint"))
    if isinstance(kind, T.MapType):
        return (_weight(F.map_keys(value), T.ArrayType(kind.keyType))
                + _weight(F.map_values(value), T.ArrayType(kind.valueType)))
    return F.lit(8).cast("bigint")


def _fixed(kind: T.DataType) -> int:
    """The bytes of every value of the type, or 0 if they differ."""
    if isinstance(kind, T.StructType):
        parts = [_fixed(f.dataType) for f in kind]
        return 8 + sum(parts) if all(parts) else 0
    return 0 if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)) else 8
