"""Mix sources to target weights by a low-discrepancy schedule.

The words of a source form a stream: its documents in the order of a hash,
over and over. The stream is cut into blocks of equally many words. A schedule
of slots says which source comes next: slot t maps the t-th golden-ratio point
through the cumulative target shares, and the k-th slot of a source takes its
k-th block.

Defined cases: a document without words (null or blank text) is kept with size
and taken 0; a null source is a source of its own, after all others; rows that
repeat count as often as they come; an empty table gives empty tables. Columns
other than doc_id, text and source are not looked at.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep
from .common import before, word_count

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 1024
_CELLS = 1024  # of [0, 1), to look points up by an equality join; layout only
_PERIOD = 1 << 31
_GOLDEN = 1_327_217_885  # odd, _PERIOD divided by the golden ratio
_SLOTS_PER_BUCKET = 1 << 14


class Mix(NamedTuple):
    """documents: (source_key, row, place, doc_id, source, size, source_size, target),
    row being a number within the source. pieces: (slot, source_key, row, pass,
    start, length), a run of words of a document; slots give the order."""

    documents: DataFrame
    pieces: DataFrame


def source_targets(sizes: DataFrame, weights=WEIGHTS, most=MOST_REPEATS) -> DataFrame:
    """(source_key, source, source_size, target, low, high) per source.

    Weights go round the sources in code-point order, null last. All words are
    shared by weight; a source above ``most`` times its size stops there and
    the rest is shared anew. low and high bound its part of [0, 1).
    """
    sources = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    listed = F.array(*(F.lit(float(w)) for w in weights))
    sources = sources.withColumn("_at", F.row_number().over(by_name)).withColumn(
        "_weight", F.element_at(listed, (F.col("_at") - 1) % len(weights) + 1)
    )
    # By cap per weight, the sources that stop at their caps come first. The
    # first that doesn't, fixes what a unit of weight gets.
    by_cap = Window.orderBy(F.col("_cap") / F.col("_weight"), "_at")
    whole = Window.partitionBy()
    sources = (
        sources.withColumn("_cap", F.col("source_size") * most)
        .withColumn("_total", F.sum("source_size").over(whole))
        .withColumn("_rest", F.col("_total") - F.coalesce(
            F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_open", F.sum("_weight").over(
            by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("_capped", F.col("_cap") * F.col("_open") <= F.col("_weight") * F.col("_rest"))
    )
    first = F.min(F.when(~F.col("_capped"), F.struct(
        F.col("_cap") / F.col("_weight"), "_at", "_rest", "_open"))).over(whole)
    share = F.col("_weight") * first["_rest"] / first["_open"]
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(share)
    sources = sources.withColumn("target", target)
    to_here = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("target").over(whole)
    return (
        sources.withColumn("high", F.try_divide(to_here, total))
        .withColumn("low", F.coalesce(F.lag("high").over(by_name), F.lit(0.0)))
        .select("source_key", "source", "source_size", "target", "low", "high")
    )


def schedule(sources: DataFrame, total: int, block_words: int) -> DataFrame:
    """(slot, source_key, block): which block comes when.

    As many slots as all words fill blocks. Points that leave a source short of
    its target, by a few blocks at most, are made good after the last slot.
    """
    spark = sources.sparkSession
    slots = -(-total // block_words)
    point = (F.col("slot") % _PERIOD * _GOLDEN % _PERIOD) / F.lit(float(_PERIOD))
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point)
    points = points.withColumn("cell", F.floor(F.col("point") * _CELLS))
    used = sources.where("target > 0").withColumn(
        "_blocks", F.ceil(F.round("target") / block_words).cast("bigint"))
    last = F.least(F.floor(F.col("high") * _CELLS), F.lit(_CELLS - 1).cast("bigint"))
    bounds = used.select(
        "source_key", "_blocks", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") * _CELLS), last)).alias("cell"),
    )
    hit = points.join(bounds, "cell").where("point >= low AND point < high")
    ranked = before(hit.select("slot", "source_key", "_blocks"), ["source_key"],
                    F.floor(F.col("slot") / _SLOTS_PER_BUCKET), ["slot"], F.lit(1), "block")
    scheduled = ranked.where("block < _blocks").select("slot", "source_key", "block")
    done = scheduled.groupBy("source_key").agg(F.count("*").alias("_done"))
    short = (
        used.join(done, "source_key", "left")
        .withColumn("_done", F.coalesce("_done", F.lit(0)))
        .where("_done < _blocks")
        .select("source_key", F.explode(F.expr("sequence(_done, _blocks - 1)")).alias("block"))
        .select((F.lit(slots) + F.col("block")).alias("slot"), "source_key", "block")
    )
    return scheduled.unionByName(short)


def mix(docs: DataFrame, weights=WEIGHTS, most=MOST_REPEATS, block_words=BLOCK_WORDS) -> Mix:
    """Mix (doc_id, text, source) rows. See Mix for what comes out."""
    sizes = keep(docs.select(
        "doc_id", "source",
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_key"),
        word_count(F.col("text")).alias("size"),
        _place().alias("place"),
    ), "sizes")
    sources = keep(source_targets(sizes, weights, most), "sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]

    bucket = F.shiftright("place", 52)
    placed = before(sizes, ["source_key"], bucket, ["place", "doc_id", "size"], F.col("size"), "at")
    placed = before(placed, ["source_key"], bucket, ["place", "doc_id", "size", "at"], F.lit(1), "row")
    documents = keep(lookup_join(placed.drop("source"), sources, "source_key"), "placed")

    begin = F.col("pass") * F.col("source_size") + F.col("at")
    whole = F.round("target").cast("bigint")
    passes = (
        documents.where("size > 0 AND target > 0")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("_from", begin)
        .withColumn("_to", F.least(F.col("_from") + F.col("size"), whole))
        .where("_from < _to")
    )
    first = F.expr(f"_from div {block_words}")
    last = F.expr(f"(_to - 1) div {block_words}")
    low = F.greatest("_from", F.col("block") * block_words)
    high = F.least("_to", (F.col("block") + 1) * block_words)
    cut = passes.withColumn("block", F.explode(F.sequence(first, last))).select(
        "source_key", "row", "pass", "block", (low - F.col("_from")).alias("start"),
        (high - low).alias("length"),
    )
    slots = schedule(sources, total, block_words)
    pieces = cut.join(slots, ["source_key", "block"]).select(
        "slot", "source_key", "row", "pass", "start", "length")
    columns = ["source_key", "row", "place", "doc_id", "source", "size", "source_size", "target"]
    return Mix(documents.select(*columns), pieces)


def taken_words(mixed: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document."""
    taken = mixed.pieces.groupBy("source_key", "row").agg(F.sum("length").alias("taken"))
    return mixed.documents.join(taken, ["source_key", "row"], "left").select(
        "doc_id", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents as the mix takes them: one row for each time it takes one.

    A last, partly taken time counts if it has at least half of the words.
    Documents without words take no part. Columns stay as they are.
    """
    mixed = mix(docs, **options)
    times = (
        mixed.pieces.groupBy("source_key", "row", "pass").agg(F.sum("length").alias("_taken"))
        .join(mixed.documents.select("source_key", "row", "place", "size"), ["source_key", "row"])
        .where("2 * _taken >= size")
        .groupBy("place").agg(F.count("*").alias("_times"))
    )
    rows = mixed.documents.groupBy("place").agg(F.count("*").alias("_rows"))
    # Rows alike in id, text and source share what they are taken.
    each = keep(times.join(rows, "place").withColumnRenamed("place", "_place"), "times")
    # The columns of the documents travel in one, so no name of theirs is met.
    packed = docs.select(F.struct("*").alias("row"), _place().alias("_place"))
    joined = lookup_join(packed, each, "_place")
    alone = joined.where("_rows = 1").withColumn("_nth", F.lit(1))
    nth = F.row_number().over(Window.partitionBy("_place").orderBy(F.xxhash64("row")))
    several = joined.where("_rows > 1").withColumn("_nth", nth)
    copies = F.expr("_times div _rows + IF(_nth <= _times % _rows, 1, 0)").cast("int")
    return (
        alone.unionByName(several)
        .withColumn("_copies", copies)
        .where("_copies > 0")
        .withColumn("_copy", F.explode(F.expr("sequence(1, _copies)")))
        .select("row.*")
    )


def _place():
    """Where a document comes in the stream of its source."""
    return F.xxhash64(F.lit("mix"), "source", "doc_id", "text")
