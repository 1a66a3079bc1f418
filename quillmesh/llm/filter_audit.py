"""What five quality filters remove, in every order they may be applied in.

Every document gets a row number. For each part and each range of row numbers
five sorted lists hold the numbers that fail a filter, and two those of good and
of toxic documents. Within a range the union of each choice of filters and the
difference of each filter's list to it are merged by galloping: heads leap over
ids to the next stretch in which a list has any. Only the sizes leave a range;
their sums over ranges tell what each filter does in each of the 120 orders.
So a part with most of the documents is worked on range by range, and what
travels after the lists does not grow with them.

Defined cases: a null text is empty, and fails A; a null lang is the part ''. A
null doc_id repeats nobody, has no label, and nobody repeats it. Repeated rows
count as often as they come; one is no copy of another with its own doc_id.
Several labels of a doc_id count together. An empty table gives no rows. Columns
other than doc_id, lang and text, and doc_id, quality and toxic of the labels,
are not looked at.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep

FILTERS = "ABCDE"
LEAST_WORDS = 200
RANGE = 1 << 16  # row numbers of one set of lists
STRETCH = 1 << 12  # ids that a merge takes at once
_SYMBOLS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_ALL = (1 << len(FILTERS)) - 1


def fails_alone(text: str) -> int:
    """Bits of the filters A to D that a text fails, A the lowest."""
    held = text.encode()
    words = held.split()
    capitals = len(held) - len(held.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 3 * len(text)) << 2
        | bool(_SYMBOLS.search(held)) << 3
    )


def failing(docs: DataFrame) -> DataFrame:
    """(row, doc_id, part, fails): a unique number and the filter bits of each document."""
    schema = "row BIGINT, doc_id {}, part STRING, fails INT, held BINARY".format(
        docs.schema["doc_id"].dataType.simpleString())

    def checked(batches):
        for batch in batches:
            texts = [text.as_py() or "" for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "doc_id", "part")),
                    pa.array(map(fails_alone, texts), pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(t.encode()) for t in texts], pa.binary()),
                ],
                names=["row", "doc_id", "part", "fails", "held"])

    part = F.coalesce("lang", F.lit("")).alias("part")
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", part, "text")
    rows = keep(numbered.mapInArrow(checked, schema), "checked")
    first = rows.groupBy("held").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_rows"))
    first = keep(first.where("_rows > 1"), "first")
    marked = lookup_join(rows, first.select("held", "_first"), "held", "left",
                         counts=first.select("held", "_rows"))
    copy = F.coalesce(F.col("_first") < F.col("doc_id"), F.lit(False)).cast("int")
    return marked.select("row", "doc_id", "part", (F.col("fails") + copy * 16).alias("fails"))


def posting_lists(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, range, n, A to E, good, toxic): sorted row numbers, and the rows of the range."""
    marks = labels.groupBy("doc_id").agg(
        *(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(n)
          for c, n in (("quality", "good"), ("toxic", "toxic"))))
    rows = lookup_join(rows, marks.where("doc_id IS NOT NULL AND (good OR toxic)"), "doc_id", "left")
    chosen = {f: F.col("fails").bitwiseAND(1 << at) > 0 for at, f in enumerate(FILTERS)}
    chosen |= {name: F.col(name) for name in ("good", "toxic")}
    return rows.groupBy("part", F.expr(f"row div {RANGE}").alias("range")).agg(
        F.count("*").alias("n"),
        *(F.sort_array(F.collect_list(F.when(held, F.col("row")))).alias(name)
          for name, held in chosen.items()))


def gallop(ids: np.ndarray, at: int, bound: int) -> int:
    """The first place from ``at`` on with an id of ``bound`` or more: leaps that double, then halving."""
    end, leap = at, 1
    while end < len(ids) and ids[end] < bound:
        at, end, leap = end, end + leap, 2 * leap
    return at + int(np.searchsorted(ids[at:end], bound))


def union(lists: list) -> np.ndarray:
    """The ids of sorted lists, once each, by a k-way merge over stretches of ids."""
    heads, merged = [0] * len(lists), [np.zeros(0, dtype=np.int64)]
    while live := [ids[head] for ids, head in zip(lists, heads) if head < len(ids)]:
        bound, some = min(live) + STRETCH, []
        for k, ids in enumerate(lists):
            end = gallop(ids, heads[k], bound)
            if end > heads[k]:
                some.append(ids[heads[k]:end])
            heads[k] = end
        merged.append(some[0] if len(some) == 1 else np.unique(np.concatenate(some)))
    return np.concatenate(merged)


def difference(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The ids of a sorted list that another does not hold, stretch by stretch."""
    at = there = 0
    left = [np.zeros(0, dtype=np.int64)]
    while at < len(ids):
        end = gallop(ids, at, ids[at] + STRETCH)
        there = gallop(others, there, ids[at])
        past = gallop(others, there, ids[end - 1] + 1)
        some, there, at = (ids[at:end], others[there:past]), past, end
        left.append(some[0] if not len(some[1]) else np.setdiff1d(*some, assume_unique=True))
    return np.concatenate(left)


def overlaps(lists: DataFrame) -> DataFrame:
    """(part, filter, before, n, either, removed, good, toxic), summed over ranges.

    For each filter and each choice ``before`` (bits) of the other four: documents
    that fail the filter or one of those, that fail it and none of those, and how
    many of the latter are good or toxic.
    """
    counted = ["n", "either", "removed", "good", "toxic"]

    def sized(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids = {name: batch.column(name)[row].values.to_numpy()
                       for name in (*FILTERS, "good", "toxic")}
                part, n = (batch.column(c)[row].as_py() for c in ("part", "n"))
                unions = [union([ids[f] for at, f in enumerate(FILTERS) if some >> at & 1])
                          for some in range(_ALL + 1)]
                out = []
                for at, name in enumerate(FILTERS):
                    for before in (some for some in range(_ALL + 1) if not some >> at & 1):
                        gone = difference(ids[name], unions[before])
                        marked = [len(gone) - len(difference(gone, ids[c])) for c in ("good", "toxic")]
                        out.append((part, name, before, n, len(unions[before | 1 << at]), len(gone), *marked))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if k < 2 else pa.int64()) for k, c in enumerate(zip(*out))],
                    names=["part", "filter", "before", *counted])

    schema = "part STRING, filter STRING, before BIGINT, " + ", ".join(f"{c} BIGINT" for c in counted)
    sums = lists.mapInArrow(sized, schema).groupBy("part", "filter", "before")
    return sums.agg(*(F.sum(c).alias(c) for c in counted))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    For every part, every order of the filters and every step of it, zeros included.
    """
    sums = keep(overlaps(posting_lists(failing(docs), labels)), "overlaps")
    others = len(FILTERS) - 1
    weight = F.element_at(
        F.array(*(F.lit(math.factorial(k) * math.factorial(others - k)) for k in range(others + 1))),
        F.bit_count("before") + 1)
    whole = sums.groupBy("part", "filter").agg(
        F.max(F.when(F.col("before") == 0, F.col("removed"))).alias("all_fails"),
        F.max(F.when(F.bit_count("before") == others, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"))
    steps = [
        ("".join(order), at + 1, name, sum(1 << FILTERS.index(f) for f in order[:at]))
        for order in itertools.permutations(FILTERS) for at, name in enumerate(order)
    ]
    steps = docs.sparkSession.createDataFrame(steps, "filter_order STRING, step INT, filter STRING, before BIGINT")
    # 600 rows, whatever the input.
    placed = sums.join(whole, ["part", "filter"]).join(F.broadcast(steps), ["filter", "before"])
    return placed.select(
        "part", "filter_order", "step", (F.col("n") - F.col("either")).alias("kept"), "removed",
        (F.col("all_fails") - F.col("removed")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
