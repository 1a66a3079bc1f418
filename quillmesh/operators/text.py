"""Word, term and author aggregates over (doc, text) rows."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import BLANKS, author_of, entry_count, entry_doc, posting_entries, tokens
from .blocks import AT, RANGE
from .skew import lookup_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 16 << 20


def words(docs: DataFrame, text: str = "text", keep: tuple = ()) -> DataFrame:
    """One row per token, case kept."""
    return docs.select(*keep, F.explode(tokens(F.col(text))).alias("word")).where("word <> ''")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    return words(docs, text).groupBy("word").agg(F.count("*").alias("n"))


def term_counts(docs: DataFrame, keep: tuple = ()) -> DataFrame:
    """(term, doc, n): occurrences of each lower-cased token per document.

    A document may be spread over many rows. ``keep`` names columns that are
    the same on every row of a document.
    """
    lowered = docs.withColumn("text", F.lower("text"))
    return (
        words(lowered, keep=("doc", *keep))
        .withColumnRenamed("word", "term")
        .groupBy("term", "doc", *keep)
        .agg(F.count("*").alias("n"))
    )


def term_lists(docs: DataFrame) -> DataFrame:
    """(term, AT, n, sum, items): the (doc, n) of each lower-cased token, for (doc, text, RANGE) rows dealt by RANGE.

    Rows are taken in document order, some CHUNK_BYTES of text at once. A chunk
    gives a row for each of its terms; AT is in the order of ranges and chunks.
    """
    lowered = docs.select(F.col(RANGE).cast("bigint").alias(RANGE), "doc", F.lower("text").alias("text"))
    schema = (f"term STRING, {AT} BIGINT, n BIGINT, sum BIGINT, "
              f"items ARRAY<STRUCT<doc: {docs.schema['doc'].dataType.simpleString()}, n: BIGINT>>")

    def lists(batches):
        range_, at = None, 0
        for chunk in _chunks(batches):
            at = at + 1 if chunk.column(RANGE)[0].as_py() == range_ else 0
            range_ = chunk.column(RANGE)[0].as_py()
            yield from _chunk_lists(chunk, (range_ << 32) + at)

    return lowered.sortWithinPartitions(RANGE, "doc").mapInArrow(lists, schema)


def _chunks(batches):
    """Tables of rows of one range each; the rows of a document are in one."""
    held = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.nbytes for t in held) >= CHUNK_BYTES:
            *done, last = _cut(pa.concat_tables(held))
            yield from done
            held = [last]
    if held:
        yield from _cut(pa.concat_tables(held))


def _cut(table) -> list:
    """The table cut where the range changes, and at the first new document after CHUNK_BYTES."""
    if not len(table):
        return [table]
    table = table.combine_chunks()
    range_, doc = table.column(RANGE).to_numpy(), _numbers(table.column("doc"))
    sizes = pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy().astype(np.int64)
    new = np.flatnonzero((np.diff(range_) != 0) | (np.diff(doc) != 0)) + 1
    cuts, before, ends = [0], 0, np.cumsum(sizes)
    for at in new:
        if range_[at] != range_[at - 1] or ends[at - 1] - before >= CHUNK_BYTES:
            cuts.append(int(at))
            before = ends[at - 1]
    return [table.slice(a, b - a) for a, b in zip(cuts, [*cuts[1:], len(table)])]


def _numbers(column) -> np.ndarray:
    """Equal values by equal numbers, in the order in which they come."""
    return column.combine_chunks().dictionary_encode("encode").indices.to_numpy()


def _chunk_counts(chunk) -> tuple:
    """Documents, terms, and the term, document and count of each pair, in order of terms."""
    docs = chunk.column("doc").combine_chunks().dictionary_encode("encode")
    words = pc.split_pattern_regex(chunk.column("text").combine_chunks(), BLANKS)
    doc = docs.indices.to_numpy()[pc.list_parent_indices(words).to_numpy()]
    words = pc.list_flatten(words).dictionary_encode()
    code = words.indices.to_numpy().astype(np.int64)
    pairs, n = np.unique(code * max(1, len(docs.dictionary)) + doc, return_counts=True)
    code, doc = np.divmod(pairs, max(1, len(docs.dictionary)))
    return docs, words.dictionary, code, doc, n


def _chunk_sums(chunk):
    """(term, n, sum): documents that hold a term of the chunk, and how often all of them do."""
    _, terms, code, _, n = _chunk_counts(chunk)
    counts = np.bincount(code, minlength=len(terms))
    sums = np.bincount(code, weights=n, minlength=len(terms)).astype(np.int64)
    rows = pa.RecordBatch.from_arrays([terms, pa.array(counts, pa.int64()), pa.array(sums)], names=["term", "n", "sum"])
    return rows.filter(pc.not_equal(terms, ""))


def _chunk_lists(chunk, at: int):
    docs, terms, code, doc, n = _chunk_counts(chunk)
    starts = np.flatnonzero(np.diff(code, prepend=-1))
    sizes = np.diff(starts, append=len(code))
    items = pa.StructArray.from_arrays([docs.dictionary.take(pa.array(doc)), pa.array(n, pa.int64())], names=["doc", "n"])
    offsets = pa.array(np.append(starts, len(code)), pa.int32())
    sums = np.add.reduceat(n, starts) if len(starts) else n
    lists = pa.RecordBatch.from_arrays(
        [terms, pa.array(np.full(len(starts), at)), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
         pa.ListArray.from_arrays(offsets, items)], names=["term", AT, "n", "sum", "items"])
    yield lists.filter(pc.not_equal(terms, ""))


def term_averages(counts: DataFrame) -> DataFrame:
    """(term, avg_count, n_docs): mean occurrences per containing document."""
    return counts.groupBy("term").agg(
        (F.sum("n") / F.count("*")).alias("avg_count"),
        F.count("*").alias("n_docs"),
    )


def document_averages(docs: DataFrame) -> DataFrame:
    """``term_averages`` of (doc, text) rows, counted where the texts lie.

    The rows of a document meet in one task, in order of documents. A chunk gives
    a row for each of its terms, so no row of a term and a document is ever made.
    """
    lowered = docs.select(F.lit(0).cast("bigint").alias(RANGE), "doc", F.lower("text").alias("text"))

    def sums(batches):
        for chunk in _chunks(batches):
            yield _chunk_sums(chunk)

    counted = lowered.repartition("doc").sortWithinPartitions("doc").mapInArrow(
        sums, "term STRING, n BIGINT, sum BIGINT")
    totals = counted.groupBy("term").agg(F.sum("n").alias("n_docs"), F.sum("sum").alias("total"))
    return totals.select("term", (F.col("total") / F.col("n_docs")).alias("avg_count"), "n_docs")


def author_documents(documents: DataFrame) -> DataFrame:
    """(author, n_docs) from the document list, one row per listed document."""
    return _with_author(documents).groupBy("author").agg(F.count("*").alias("n_docs"))


def author_terms(counts: DataFrame) -> DataFrame:
    """(author, term, tf, df) from (term, doc, n) rows."""
    return (
        _with_author(counts)
        .groupBy("author", "term")
        .agg(F.sum("n").alias("tf"), F.count("*").alias("df"))
    )


def term_weights(author_term: DataFrame, author_docs: DataFrame) -> DataFrame:
    """Add tf_idf = tf * ln(n_docs / (df + 1)); authors not listed fall out."""
    idf = F.log(F.col("n_docs") / (F.col("df") + F.lit(1.0)))
    return lookup_join(author_term, author_docs, "author").select(
        "author", "term", "tf", "df", (F.col("tf") * idf).alias("tf_idf")
    )


def parse_index(lines: DataFrame) -> DataFrame:
    """(term, doc, n) back from (key, value) rows of a text index."""
    entries = lines.select(
        F.col("key").alias("term"), F.explode(posting_entries(F.col("value"))).alias("entry")
    ).where("entry <> ''")
    return entries.select(
        "term", entry_doc(F.col("entry")).alias("doc"), entry_count(F.col("entry")).alias("n")
    )


def above_average(averages: DataFrame, threshold: float) -> DataFrame:
    return averages.where(F.col("avg_count") > threshold)


def top_averages(averages: DataFrame, k: int = 100) -> DataFrame:
    """The k highest averages; equal ones in term order."""
    return averages.orderBy(F.desc("avg_count"), "term").limit(k)


def sort_by_average(index: DataFrame) -> DataFrame:
    """Total ascending order by average; equal ones in term, then block order."""
    keys = ["avg_count", "term"] + (["block"] if "block" in index.columns else [])
    return index.orderBy(*keys)


def _with_author(rows: DataFrame) -> DataFrame:
    if "author" in rows.columns:
        return rows
    return rows.withColumn("author", author_of(F.col("doc")))
