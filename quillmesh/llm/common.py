"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """The number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def before(rows: DataFrame, group: list, bucket: Column, order: list, value: Column,
           name: str) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of a group, as a long.

    Rows go by (bucket, order). Sums run within (group, bucket) and the totals
    of earlier buckets shift them, so a group with most of the rows is worked
    on by as many tasks as it has buckets.
    """
    dealt = rows.withColumn("_bucket", bucket).withColumn("_value", value.cast("bigint"))
    inner = Window.partitionBy(*group, "_bucket").orderBy(*order)
    earlier = Window.partitionBy(*group).orderBy("_bucket")
    to_here = (Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*group, "_bucket")
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier.rowsBetween(*to_here)), F.lit(0)))
        .drop("_sum")
    )
    within = F.coalesce(F.sum("_value").over(inner.rowsBetween(*to_here)), F.lit(0))
    return (
        dealt.withColumn("_within", within)
        .join(offsets, [*group, "_bucket"])
        .withColumn(name, F.col("_within") + F.col("_offset"))
        .drop("_bucket", "_value", "_within", "_offset")
    )


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def about(rows: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """About ``n`` rows, chosen by a hash of the key; all, if there are fewer."""
    total = rows.agg(F.count("*")).first()[0]
    if total <= n:
        return rows
    share = int(n / total * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < share)
