"""Word count, inverted index, TF-IDF and the table of averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import leading_number, render_index_value, render_postings
from ..operators import text as ops
from ..operators.blocks import BLOCK_SIZE, RANGE, cut_lists, item_splits, list_blocks, with_range
from ..sources.keyed_table import put_rows
from ..sources.scratch import scratch_path
from ..sources.text import write_key_values, write_ordered

RANGE_DOCS = 2048


def word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n), case-sensitive."""
    return ops.word_counts(docs, text)


def term_counts(docs: DataFrame, keep: tuple = ()) -> DataFrame:
    """(term, doc, n) - the long form of the index."""
    return ops.term_counts(docs, keep)


def term_averages(docs: DataFrame, whole: bool = False) -> DataFrame:
    """(term, avg_count, n_docs) straight from documents; ``whole`` as for ``inverted_index``."""
    return ops.document_averages(docs) if whole else ops.term_averages(term_counts(docs))


def inverted_index(docs: DataFrame, size: int = BLOCK_SIZE, ranges: int | None = None,
                   names: DataFrame | None = None, whole: bool = False) -> DataFrame:
    """(term, block, avg_count, n_docs, postings), postings in document order.

    ``avg_count`` and ``n_docs`` are those of the whole term on each block.
    ``names`` lists the documents (doc) where that is cheaper to scan than
    ``docs``, as it is for text files. ``whole`` tells that a document is one row,
    not many lines: then texts are dealt by ranges of documents and their terms
    counted and listed where they lie.
    """
    listed = (docs if names is None else names).select("doc")
    if whole:
        dealt = with_range(docs.select("doc", "text"), "doc", item_splits(listed, ranges, RANGE_DOCS))
        blocks = cut_lists(ops.term_lists(dealt.repartition(RANGE)), "term", size)
    else:
        blocks = list_blocks(term_counts(docs), "term", "doc", lambda: item_splits(listed, ranges), ("n",), "n", size)
    return blocks.select(
        "term",
        "block",
        (F.col("total") / F.col("n_items")).alias("avg_count"),
        F.col("n_items").alias("n_docs"),
        F.col("items").alias("postings"),
    )


def index_lines(index: DataFrame) -> DataFrame:
    """(key, value) text form of an index; a blocked term has a line per block."""
    value = render_index_value(F.col("avg_count"), F.col("postings"))
    return index.select(F.col("term").alias("key"), value.alias("value"))


def index_by_frequency(index: DataFrame) -> DataFrame:
    """The index in ascending order of average."""
    return ops.sort_by_average(index)


def sort_index_lines(lines: DataFrame) -> DataFrame:
    """Raw ``term<tab>avg, ...`` lines in ascending order of average."""
    return lines.orderBy(leading_number(F.col("value")), "value")


def write_sorted_index(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The lines as ``sort_index_lines`` orders them, so that files by name and line keep the order."""
    write_ordered(lines, path, F.col("value"), leading_number(F.col("value")), F.col("value"), mode=mode)


def tf_idf(docs: DataFrame, documents: DataFrame) -> DataFrame:
    """(author, term, tf, df, tf_idf); ``documents`` lists what authors wrote.

    The author is an ``author`` column where there is one, else it is read off
    the document name.
    """
    keep = ("author",) if "author" in docs.columns else ()
    return tf_idf_from_counts(term_counts(docs, keep), documents)


def tf_idf_from_counts(counts: DataFrame, documents: DataFrame) -> DataFrame:
    return ops.term_weights(ops.author_terms(counts), ops.author_documents(documents))


def tf_idf_from_lines(lines: DataFrame, documents: DataFrame) -> DataFrame:
    """TF-IDF off a text index read as (key, value) rows."""
    return tf_idf_from_counts(ops.parse_index(lines), documents)


def store_averages(docs: DataFrame, path: str, whole: bool = False) -> int:
    """Put each term's average into the keyed table at ``path``."""
    averages = term_averages(docs, whole).select(F.col("term").alias("word"), "avg_count")
    return put_rows(averages, path, "word")


def store_index(docs: DataFrame, path: str, out: str, names: DataFrame | None = None) -> int:
    """Averages into the keyed table at ``path``, bare posting lists to ``out``.

    The index is worked out once, into a scratch table both are read from.
    """
    spark = docs.sparkSession
    held = scratch_path(spark, "index")
    inverted_index(docs, names=names).write.parquet(held)
    index = spark.read.parquet(held)
    write_key_values(index, out, F.col("term"), render_postings(F.col("postings")))
    first = index.where("block = 0").select(F.col("term").alias("word"), "avg_count")
    return put_rows(first, path, "word")
