"""Text expressions: tokens, authors and the text form of posting lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks that separate tokens, the ending of a document file,
# and where the author part of a document name stops.
BLANKS = r"[ \t\n\r\f]+"
DOCUMENT_ENDING = r"\.txt\.segmented$"
AUTHOR_END = r"[0-9]+.*$"


def tokens(text: Column) -> Column:
    """Array of blank-separated tokens; may hold '' at either end."""
    return F.split(text, BLANKS)


def document_name(file_name: Column) -> Column:
    return F.regexp_replace(file_name, DOCUMENT_ENDING, "")


def author_of(doc: Column) -> Column:
    """Document name up to its first digit."""
    return F.regexp_replace(doc, AUTHOR_END, "")


def render_postings(postings: Column) -> Column:
    """``doc: n; doc: n; `` for an array of (doc, n) structs."""
    return F.array_join(
        F.transform(
            postings,
            lambda p: F.concat(p["doc"], F.lit(": "), p["n"].cast("string"), F.lit("; ")),
        ),
        "",
    )


def render_index_value(avg_count: Column, postings: Column) -> Column:
    """``avg, doc: n; doc: n; `` - the value half of an index line."""
    return F.concat(avg_count.cast("string"), F.lit(", "), render_postings(postings))


def posting_entries(value: Column) -> Column:
    """Array of ``doc: n`` entries held by the value half of an index line."""
    return F.split(F.substring(value, F.instr(value, ",") + 2, F.length(value)), r";\s")


def entry_count(entry: Column) -> Column:
    return F.substring_index(entry, ": ", -1).cast("bigint")


def entry_doc(entry: Column) -> Column:
    """Everything before the last ``: ``, so names may hold the separator."""
    count = F.substring_index(entry, ": ", -1)
    return F.left(entry, F.length(entry) - F.length(count) - 2)


def leading_number(line: Column) -> Column:
    """The average at the head of an index line's value; a bad number raises."""
    value = F.split(line, "\t", 2)[1]
    return F.substring_index(value, ",", 1).cast("double")
