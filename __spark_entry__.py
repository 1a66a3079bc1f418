"""Registered queries over the test tables, with SQL to check them against.

Stand-ins: a document is a row of ``documents`` (author = source), an edge is a
row of ``lineitem`` (part -> supplier, both taken as plain vertex ids), a
labelled sample is a row of ``embeddings``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillmesh.functions import vectors  # noqa: E402
from quillmesh.functions.text import leading_number, render_postings  # noqa: E402
from quillmesh.operators import graph as graph_ops  # noqa: E402
from quillmesh.operators import pairs as pair_ops  # noqa: E402
from quillmesh.operators import text as text_ops  # noqa: E402
from quillmesh.operators.skew import spread  # noqa: E402
from quillmesh.plans import graph, metric, text  # noqa: E402
from quillmesh.sources import text as files  # noqa: E402
from quillmesh.sources.delimited import create_delimited_table, load_delimited  # noqa: E402
from quillmesh.sources.keyed_table import compact, export_rows, scan_rows  # noqa: E402
from quillmesh.sources.matrices import model_frame  # noqa: E402
from quillmesh.sources.scratch import scratch_path  # noqa: E402

try:
    import corpus_pipeline
    from quillmesh.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "quillmesh.llm"):
        raise
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
DIMENSIONS = 64
BLOCK = 100  # small enough for the common terms of sf0.01 to fill several blocks
THRESHOLD = 3.0
LR = 0.1
DIGITS = 6  # sums run in no fixed order


# --- inputs -----------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        F.col("doc_id").cast("string").alias("doc"), F.col("source").alias("author"), "text"
    )


def document_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("doc"), F.col("source").alias("author")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x")
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "label"
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pair table: every sample with those up to 8 ids away, itself too."""
    rows = samples(spark, sf_dir)
    steps = F.explode(F.sequence(F.lit(-8), F.lit(8))).alias("step")
    links = rows.select(F.col("id").alias("i"), steps).select(
        "i", (F.col("i") + F.col("step")).alias("j")
    )
    return pair_ops.difference_pairs(rows, links)


def _round(column: str):
    return F.round(F.col(column), DIGITS).alias(column)


# --- queries ----------------------------------------------------------------


def word_count(spark, sf_dir):
    return text.word_count(documents(spark, sf_dir))


def term_doc_counts(spark, sf_dir):
    return text.term_counts(documents(spark, sf_dir))


def _index(spark, sf_dir):
    return text.inverted_index(
        documents(spark, sf_dir), size=BLOCK, names=document_list(spark, sf_dir), whole=True
    )


def inverted_index(spark, sf_dir):
    index = _index(spark, sf_dir)
    return index.withColumn("postings", render_postings(F.col("postings")))


def postings_roundtrip(spark, sf_dir):
    index = _index(spark, sf_dir)
    return text_ops.parse_index(text.index_lines(index))


def sorted_index_lines(spark, sf_dir):
    """The lines of the text index by average, cut up again to be compared."""
    tab = F.lit("\t")
    lines = text.index_lines(_index(spark, sf_dir))
    lines = text.sort_index_lines(lines.select(F.concat("key", tab, "value").alias("value")))
    postings = F.expr("substring(value, instr(value, '\t') + 1)")
    return lines.select(
        F.substring_index("value", "\t", 1).alias("term"),
        leading_number(F.col("value")).alias("avg_count"),
        F.regexp_replace(postings, "^[^,]*, ", "").alias("postings"),
    )


def sorted_lines_written(spark, sf_dir):
    """The lines of the text index in files, read back with their places in the order."""
    path = scratch_path(spark, "sorted-lines")
    lines = text.index_lines(_index(spark, sf_dir))
    text.write_sorted_index(lines.select(F.concat("key", F.lit("\t"), "value").alias("value")), path)
    return files.read_ordered(spark, path).select(
        "position", F.substring_index("value", "\t", 1).alias("term"),
        leading_number(F.col("value")).alias("avg_count"))


def index_by_frequency(spark, sf_dir):
    averages = text.term_averages(documents(spark, sf_dir), whole=True)
    return text.index_by_frequency(averages).select("term", "avg_count")


def frequent_terms(spark, sf_dir):
    path = scratch_path(spark, "averages")
    text.store_averages(documents(spark, sf_dir), path, whole=True)
    stored = scan_rows(spark, path).withColumnRenamed("word", "term")
    return text_ops.above_average(stored, THRESHOLD)


def averages_after_update(spark, sf_dir):
    """Averages off the documents with an even number, then those off the others put over them."""
    path = scratch_path(spark, "averages")
    for rest in (0, 1):
        part = documents(spark, sf_dir).where(F.col("doc").cast("bigint") % 2 == rest)
        text.store_averages(part, path, whole=True)
    compact(spark, path)
    return scan_rows(spark, path).withColumnRenamed("word", "term")


def exported_averages(spark, sf_dir):
    """The table of averages written as text, loaded into an SQL table and selected from."""
    path = scratch_path(spark, "averages")
    text.store_averages(documents(spark, sf_dir), path, whole=True)
    out = scratch_path(spark, "export")
    export_rows(spark, path, out)
    table = "exported_" + uuid.uuid4().hex
    create_delimited_table(spark, table, "word STRING, count DOUBLE")
    load_delimited(spark, table, out)
    return spark.sql(f"SELECT word AS term, count AS avg_count FROM {table} WHERE count > {THRESHOLD}")


def edges_from_lines(spark, sf_dir):
    """Edges written one to a line, read back and made adjacency lists."""
    path = scratch_path(spark, "edges")
    files.write_values(edges(spark, sf_dir), path, F.concat_ws(" ", "src", "dst"))
    ends = files.read_edges(spark, path).select(*(F.col(c).cast("bigint").alias(c) for c in ("src", "dst")))
    lists = graph.adjacency(ends, "undirected", size=BLOCK)
    return lists.withColumn("neighbours", F.array_join("neighbours", " "))


def documents_from_lines(spark, sf_dir):
    """Words counted off text lines, and the list of documents read back as lines."""
    path = scratch_path(spark, "lines")
    files.write_values(documents(spark, sf_dir), path, F.col("text"))
    return text.word_count(files.read_lines(spark, path), "value")


def authors_from_list(spark, sf_dir):
    """Documents of each author off a written list of names."""
    path = scratch_path(spark, "list")
    files.write_values(_named(document_list(spark, sf_dir)), path, F.col("doc"))
    return text_ops.author_documents(files.read_document_list(spark, path))


def pairs_from_lines(spark, sf_dir):
    """The success of samples off pairs and labels written as text and read back."""
    table, marks = scratch_path(spark, "pair-lines"), scratch_path(spark, "label-lines")
    numbers = F.array_join(F.col("x").cast("array<string>"), " ")
    files.write_key_values(pairs(spark, sf_dir), table, F.concat_ws(",", "i", "j"), numbers)
    files.write_key_values(labels(spark, sf_dir), marks, F.col("id"), F.col("label"))
    found = metric.pair_success(
        files.read_pairs(spark, table), files.read_labels(spark, marks), np.eye(DIMENSIONS))
    return found.select(F.col("i").cast("bigint").alias("i"), _round("p"))


def top_average_terms(spark, sf_dir):
    averages = text.term_averages(documents(spark, sf_dir), whole=True)
    return text_ops.top_averages(averages, 100).select("term", "avg_count")


def author_documents(spark, sf_dir):
    return text_ops.author_documents(document_list(spark, sf_dir))


def _named(rows: DataFrame) -> DataFrame:
    """Documents named author and number, with no other sign of the author."""
    return rows.withColumn("doc", F.concat("author", "doc")).drop("author")


def authors_from_names(spark, sf_dir):
    return text_ops.author_documents(_named(document_list(spark, sf_dir)))


def tf_idf_from_lines(spark, sf_dir):
    names = _named(document_list(spark, sf_dir))
    index = text.inverted_index(_named(documents(spark, sf_dir)), size=BLOCK, names=names, whole=True)
    weights = text.tf_idf_from_lines(text.index_lines(index), names)
    return weights.withColumn("tf_idf", _round("tf_idf"))


def tf_idf(spark, sf_dir):
    weights = text.tf_idf(documents(spark, sf_dir), document_list(spark, sf_dir))
    return weights.withColumn("tf_idf", _round("tf_idf"))


def _adjacency(mode):
    def query(spark, sf_dir):
        lists = graph.adjacency(edges(spark, sf_dir), mode, size=BLOCK)
        return lists.withColumn("neighbours", F.array_join("neighbours", " "))

    return query


def _triangles(mode):
    def query(spark, sf_dir):
        return graph.triangle_count(edges(spark, sf_dir), mode)

    return query


def degrees(spark, sf_dir):
    return graph_ops.degrees(graph_ops.simple_edges(edges(spark, sf_dir)))


def pair_kernel(spark, sf_dir):
    kernels = pair_ops.pair_kernels(pairs(spark, sf_dir), np.eye(DIMENSIONS))
    return kernels.select("i", "j", _round("k"))


def pair_probabilities(spark, sf_dir):
    table = pairs(spark, sf_dir)
    kernels = pair_ops.pair_kernels(table, np.eye(DIMENSIONS)).drop("x")
    return pair_ops.pair_probabilities(kernels, table).select("i", "j", _round("p"))


def pair_success(spark, sf_dir):
    found = metric.pair_success(
        pairs(spark, sf_dir), labels(spark, sf_dir), np.eye(DIMENSIONS)
    )
    return found.select("i", _round("p"))


def pair_gradient(spark, sf_dir):
    gradient = pair_ops.pair_gradient(
        pairs(spark, sf_dir), labels(spark, sf_dir), np.eye(DIMENSIONS)
    )
    return gradient.select("r", "c", F.round("v", DIGITS).alias("g"))


def pair_combine(spark, sf_dir):
    table = pairs(spark, sf_dir)
    kernels = pair_ops.pair_kernels(table, np.eye(DIMENSIONS)).select("i", "j", "k")
    squares = table.select("i", "j", vectors.squared_norm(F.col("x")).alias("d"))
    product = F.col("left.k") * F.col("right.d")
    return pair_ops.combine(kernels, squares, ["i", "j"], product).select("i", "j", _round("v"))


def sample_success(spark, sf_dir):
    found = metric.sample_success(samples(spark, sf_dir), labels(spark, sf_dir))
    return found.select("id", _round("p"))


def expected_correct(spark, sf_dir):
    found = metric.sample_success(samples(spark, sf_dir), labels(spark, sf_dir))
    return metric.expected_correct(found).select(_round("f"))


def nca_gradient(spark, sf_dir):
    gradient = metric.nca_gradient(samples(spark, sf_dir), labels(spark, sf_dir))
    return gradient.select("r", "c", F.round("v", DIGITS).alias("g"))


def nca_one_epoch(spark, sf_dir):
    history = metric.nca_fit(samples(spark, sf_dir), labels(spark, sf_dir), LR, epochs=1)
    model = model_frame(spark, history).where("epoch = 1")
    return model.select("r", "c", F.round("v", DIGITS).alias("a"))


def nca_three_epochs(spark, sf_dir):
    """A fit broken off after one epoch and gone on with from what is stored."""
    path = scratch_path(spark, "model")
    for epochs in (1, 3):
        fitted = metric.nca_fit_stored(
            samples(spark, sf_dir), labels(spark, sf_dir), LR, epochs, path)
    return fitted.select("epoch", "r", "c", F.round("v", DIGITS).alias("a"), _round("f"))


def knn_predict(spark, sf_dir):
    return metric.knn_predict(samples(spark, sf_dir), labels(spark, sf_dir), k=5)


def knn_queries(spark, sf_dir):
    rows = samples(spark, sf_dir)
    asking, known = rows.where("id % 5 = 0"), rows.where("id % 5 <> 0")
    return metric.knn_predict_for(asking, known, labels(spark, sf_dir), k=5)


def entry(spark: SparkSession) -> DataFrame:
    """TF-IDF per author over the documents."""
    return tf_idf(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return _own_queries()
    return _own_queries() | llm.queries() | {"pipeline": corpus_pipeline.run}


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "word_count": word_count,
        "term_doc_counts": term_doc_counts,
        "inverted_index": inverted_index,
        "postings_roundtrip": postings_roundtrip,
        "sorted_index_lines": sorted_index_lines,
        "sorted_lines_written": sorted_lines_written,
        "index_by_frequency": index_by_frequency,
        "frequent_terms": frequent_terms,
        "averages_after_update": averages_after_update,
        "exported_averages": exported_averages,
        "top_average_terms": top_average_terms,
        "author_documents": author_documents,
        "authors_from_names": authors_from_names,
        "authors_from_list": authors_from_list,
        "documents_from_lines": documents_from_lines,
        "tf_idf": tf_idf,
        "tf_idf_from_lines": tf_idf_from_lines,
        "adjacency_any": _adjacency("undirected"),
        "adjacency_reciprocal": _adjacency("directed"),
        "edges_from_lines": edges_from_lines,
        "degrees": degrees,
        "triangles_any": _triangles("undirected"),
        "triangles_reciprocal": _triangles("directed"),
        "pair_kernel": pair_kernel,
        "pair_probabilities": pair_probabilities,
        "pair_success": pair_success,
        "pair_gradient": pair_gradient,
        "pair_combine": pair_combine,
        "pairs_from_lines": pairs_from_lines,
        "sample_success": sample_success,
        "expected_correct": expected_correct,
        "nca_gradient": nca_gradient,
        "nca_one_epoch": nca_one_epoch,
        "nca_three_epochs": nca_three_epochs,
        "knn_predict": knn_predict,
        "knn_queries": knn_queries,
    }


# --- the same in SQL --------------------------------------------------------

_TERMS = r"""
tokens AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc, source AS author,
         unnest(regexp_split_to_array(lower(text), '[ \t\n\r\f]+')) AS term
  FROM documents),
counts AS (
  SELECT term, doc, author, count(*) AS n
  FROM tokens WHERE term <> '' GROUP BY term, doc, author),
averages AS (
  SELECT term, CAST(sum(n) AS DOUBLE) / count(*) AS avg_count, count(*) AS n_docs
  FROM counts GROUP BY term)
"""

_AUTHOR = "regexp_replace(source || CAST(doc_id AS VARCHAR), '[0-9]+.*$', '')"

_EDGES_ANY = """
lines AS (
  SELECT DISTINCT least(l_partkey, l_suppkey) AS lo, greatest(l_partkey, l_suppkey) AS hi
  FROM lineitem WHERE l_partkey <> l_suppkey)
"""

_EDGES_RECIPROCAL = """
directed AS (
  SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE l_partkey <> l_suppkey),
lines AS (
  SELECT a.src AS lo, a.dst AS hi
  FROM directed a JOIN directed b ON a.src = b.dst AND a.dst = b.src
  WHERE a.src < a.dst)
"""

_BOTH = """
ends AS (
  SELECT lo AS vertex, hi AS neighbour FROM lines
  UNION ALL SELECT hi, lo FROM lines)
"""

_ADJACENCY = f"""
, {_BOTH}, ranked AS (
  SELECT vertex, neighbour,
         (row_number() OVER (PARTITION BY vertex ORDER BY neighbour) - 1) // {BLOCK} AS block,
         count(*) OVER (PARTITION BY vertex) AS degree
  FROM ends)
SELECT vertex, block, degree,
       string_agg(CAST(neighbour AS VARCHAR), ' ' ORDER BY neighbour) AS neighbours
FROM ranked GROUP BY vertex, block, degree
"""

_TRIANGLES = """
SELECT count(*) AS n
FROM lines a JOIN lines b ON a.hi = b.lo JOIN lines c ON c.lo = a.lo AND c.hi = b.hi
"""

_SAMPLES = """
samples AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
"""

_KERNEL = """
CASE WHEN a.id = b.id THEN 0.0 ELSE exp(-pow(list_distance(a.x, b.x), 2)) END AS k
"""

# Pairs up to 8 ids apart, and all pairs.
_NEAR = f"""
{_SAMPLES}, kernels AS (
  SELECT a.id AS i, b.id AS j, a.label = b.label AS same, {_KERNEL}
  FROM samples a JOIN samples b ON b.id BETWEEN a.id - 8 AND a.id + 8)
"""
_ALL = f"""
{_SAMPLES}, kernels AS (
  SELECT a.id AS i, b.id AS j, a.label = b.label AS same, {_KERNEL}
  FROM samples a CROSS JOIN samples b)
"""

_SUCCESS = """
success AS (
  SELECT i, sum(k) AS z, sum(CASE WHEN same THEN k ELSE 0 END) / sum(k) AS p
  FROM kernels GROUP BY i)
"""

# With w_ij = p_ij (p_i - [same]) every row sum of w is 0, so the sum of
# w_ij x_ij x_ij^T is  sum_j c_j x_j x_j^T - sum_i (x_i y_i^T + y_i x_i^T)
# with c_j = sum_i w_ij and y_i = sum_j w_ij x_j.
_GRADIENT = f"""
{_SUCCESS}, weights AS (
  SELECT i, j, k * (p - CAST(same AS INTEGER)) / z AS w FROM kernels JOIN success USING (i)),
entries AS (
  SELECT id, unnest(x) AS v, CAST(unnest(range(len(x))) AS INTEGER) AS r FROM samples),
columns AS (SELECT j, sum(w) AS c FROM weights GROUP BY j),
means AS (
  SELECT i, r, sum(w * v) AS y FROM weights JOIN entries ON entries.id = weights.j GROUP BY i, r),
squares AS (
  SELECT a.r AS r, b.r AS c, sum(columns.c * a.v * b.v) AS v
  FROM columns JOIN entries a ON a.id = columns.j JOIN entries b ON b.id = columns.j
  GROUP BY a.r, b.r),
crosses AS (
  SELECT entries.r AS r, means.r AS c, sum(entries.v * means.y) AS v
  FROM entries JOIN means ON entries.id = means.i GROUP BY entries.r, means.r),
gradient AS (
  SELECT s.r, s.c, s.v - a.v - b.v AS g
  FROM squares s JOIN crosses a ON a.r = s.r AND a.c = s.c
                 JOIN crosses b ON b.r = s.c AND b.c = s.r)
"""


def _epochs(last: int) -> str:
    """m0, m1, ...: A by epoch, and f0, f1, ...: the expected success there, all pairs counted."""
    parts = [f"""{_SAMPLES}, entries AS (
      SELECT id, unnest(x) AS v, CAST(unnest(range(len(x))) AS INTEGER) AS r FROM samples),
    m0 AS (
      SELECT a.r, b.r AS c, CASE WHEN a.r = b.r THEN 1.0::DOUBLE ELSE 0.0 END AS a
      FROM (SELECT DISTINCT r FROM entries) a CROSS JOIN (SELECT DISTINCT r FROM entries) b)"""]
    for e in range(last + 1):
        parts.append(f"""
    moved{e} AS MATERIALIZED (
      SELECT id, list(y ORDER BY r) AS x
      FROM (SELECT entries.id, m.r, sum(m.a * entries.v) AS y
            FROM m{e} m JOIN entries ON entries.r = m.c GROUP BY entries.id, m.r)
      GROUP BY id),
    kernels{e} AS MATERIALIZED (
      SELECT a.id AS i, b.id AS j, s.label = t.label AS same, {_KERNEL}
      FROM moved{e} a CROSS JOIN moved{e} b JOIN samples s ON s.id = a.id JOIN samples t ON t.id = b.id),
    success{e} AS MATERIALIZED (
      SELECT i, sum(k) AS z, sum(CASE WHEN same THEN k ELSE 0 END) / sum(k) AS p
      FROM kernels{e} GROUP BY i),
    f{e} AS (SELECT sum(p) AS f FROM success{e})""")
        if e < last:
            parts.append(f"""
    weights{e} AS MATERIALIZED (
      SELECT i, j, k * (p - CAST(same AS INTEGER)) / z AS w FROM kernels{e} JOIN success{e} USING (i)),
    columns{e} AS (SELECT j, sum(w) AS c FROM weights{e} GROUP BY j),
    means{e} AS (
      SELECT i, r, sum(w * v) AS y
      FROM weights{e} w JOIN entries ON entries.id = w.j GROUP BY i, r),
    squares{e} AS (
      SELECT a.r AS r, b.r AS c, sum(w.c * a.v * b.v) AS v
      FROM columns{e} w JOIN entries a ON a.id = w.j JOIN entries b ON b.id = w.j GROUP BY a.r, b.r),
    crosses{e} AS MATERIALIZED (
      SELECT entries.r AS r, m.r AS c, sum(entries.v * m.y) AS v
      FROM entries JOIN means{e} m ON entries.id = m.i GROUP BY entries.r, m.r),
    gradient{e} AS (
      SELECT s.r, s.c, s.v - a.v - b.v AS g
      FROM squares{e} s JOIN crosses{e} a ON a.r = s.r AND a.c = s.c
                        JOIN crosses{e} b ON b.r = s.c AND b.c = s.r),
    m{e + 1} AS MATERIALIZED (
      SELECT m.r, m.c, m.a + {LR} * step.g AS a
      FROM m{e} m JOIN (
        SELECT a.r, g.c, sum(a.a * g.g) AS g
        FROM m{e} a JOIN gradient{e} g ON g.r = a.c GROUP BY a.r, g.c) step
      ON step.r = m.r AND step.c = m.c)""")
    rows = " UNION ALL ".join(
        f"SELECT CAST({e} AS INTEGER) AS epoch, r, c, {_rounded('a')} AS a, {_rounded('f')} AS f "
        f"FROM m{e} CROSS JOIN f{e}" for e in range(last + 1))
    return f"WITH {','.join(parts)} {rows}"


def _rounded(expression: str) -> str:
    return f"round({expression}, {DIGITS}) + 0.0"


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return _own_sql()
    of_pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _own_sql() | llm.oracle_sql() | of_pipeline


def _own_sql() -> dict[str, str]:
    counts = f"WITH {_TERMS} SELECT term, doc, n FROM counts"
    return {
        "word_count": r"""
            SELECT word, count(*) AS n
            FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "term_doc_counts": counts,
        "inverted_index": f"""
            WITH {_TERMS}, ranked AS (
              SELECT term, doc, n,
                     (row_number() OVER (PARTITION BY term ORDER BY doc) - 1) // {BLOCK} AS block
              FROM counts)
            SELECT term, block, avg_count, n_docs,
                   string_agg(doc || ': ' || n || '; ', '' ORDER BY doc) AS postings
            FROM ranked JOIN averages USING (term) GROUP BY term, block, avg_count, n_docs""",
        "postings_roundtrip": counts,
        "sorted_index_lines": f"""
            WITH {_TERMS}, ranked AS (
              SELECT term, doc, n,
                     (row_number() OVER (PARTITION BY term ORDER BY doc) - 1) // {BLOCK} AS block
              FROM counts)
            SELECT term, avg_count, string_agg(doc || ': ' || n || '; ', '' ORDER BY doc) AS postings
            FROM ranked JOIN averages USING (term) GROUP BY term, block, avg_count""",
        "sorted_lines_written": f"""
            WITH {_TERMS}, ranked AS (
              SELECT term, doc, n,
                     (row_number() OVER (PARTITION BY term ORDER BY doc) - 1) // {BLOCK} AS block
              FROM counts),
            lines AS (
              SELECT term, avg_count, string_agg(doc || ': ' || n || '; ', '' ORDER BY doc) AS postings
              FROM ranked JOIN averages USING (term) GROUP BY term, block, avg_count)
            SELECT row_number() OVER (ORDER BY avg_count, term || chr(9), postings) AS position,
                   term, avg_count
            FROM lines""",
        "index_by_frequency": f"WITH {_TERMS} SELECT term, avg_count FROM averages",
        "frequent_terms": f"""
            WITH {_TERMS} SELECT term, avg_count FROM averages WHERE avg_count > {THRESHOLD}""",
        "exported_averages": f"""
            WITH {_TERMS} SELECT term, avg_count FROM averages WHERE avg_count > {THRESHOLD}""",
        "averages_after_update": f"""
            WITH {_TERMS}, halves AS (
              SELECT term, CAST(doc AS BIGINT) % 2 AS rest, CAST(sum(n) AS DOUBLE) / count(*) AS avg_count
              FROM counts GROUP BY ALL)
            SELECT term, arg_max(avg_count, rest) AS avg_count FROM halves GROUP BY term""",
        "top_average_terms": f"""
            WITH {_TERMS} SELECT term, avg_count FROM averages
            ORDER BY avg_count DESC, term LIMIT 100""",
        "author_documents": """
            SELECT source AS author, count(*) AS n_docs FROM documents GROUP BY source""",
        "authors_from_names": f"SELECT {_AUTHOR} AS author, count(*) AS n_docs FROM documents GROUP BY 1",
        "authors_from_list": f"SELECT {_AUTHOR} AS author, count(*) AS n_docs FROM documents GROUP BY 1",
        "documents_from_lines": r"""
            SELECT word, count(*) AS n
            FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "tf_idf_from_lines": f"""
            WITH {_TERMS}, authors AS (
              SELECT {_AUTHOR} AS author, count(*) AS n_docs FROM documents GROUP BY 1),
            author_terms AS (
              SELECT regexp_replace(author || doc, '[0-9]+.*$', '') AS author, term,
                     CAST(sum(n) AS BIGINT) AS tf, count(*) AS df
              FROM counts GROUP BY 1, 2)
            SELECT author, term, tf, df, {_rounded('tf * ln(authors.n_docs / (df + 1.0))')} AS tf_idf
            FROM author_terms JOIN authors USING (author)""",
        "tf_idf": f"""
            WITH {_TERMS}, authors AS (
              SELECT source AS author, count(*) AS n_docs FROM documents GROUP BY source),
            author_terms AS (
              SELECT author, term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df
              FROM counts GROUP BY author, term)
            SELECT author, term, tf, df, {_rounded('tf * ln(authors.n_docs / (df + 1.0))')} AS tf_idf
            FROM author_terms JOIN authors USING (author)""",
        "adjacency_any": f"WITH {_EDGES_ANY} {_ADJACENCY}",
        "edges_from_lines": f"WITH {_EDGES_ANY} {_ADJACENCY}",
        "adjacency_reciprocal": f"WITH {_EDGES_RECIPROCAL} {_ADJACENCY}",
        "degrees": f"""
            WITH {_EDGES_ANY}, {_BOTH}
            SELECT vertex, count(*) AS degree FROM ends GROUP BY vertex""",
        "triangles_any": f"WITH {_EDGES_ANY} {_TRIANGLES}",
        "triangles_reciprocal": f"WITH {_EDGES_RECIPROCAL} {_TRIANGLES}",
        "pair_kernel": f"WITH {_NEAR} SELECT i, j, {_rounded('k')} AS k FROM kernels",
        "pair_probabilities": f"""
            WITH {_NEAR}, {_SUCCESS}
            SELECT i, j, {_rounded('k / z')} AS p FROM kernels JOIN success USING (i)""",
        "pairs_from_lines": f"WITH {_NEAR}, {_SUCCESS} SELECT i, {_rounded('p')} AS p FROM success",
        "pair_success": f"WITH {_NEAR}, {_SUCCESS} SELECT i, {_rounded('p')} AS p FROM success",
        "pair_gradient": f"""
            WITH {_NEAR}, {_GRADIENT} SELECT r, c, {_rounded('g')} AS g FROM gradient""",
        "pair_combine": f"""
            WITH {_NEAR}
            SELECT i, j, {_rounded('k * pow(list_distance(a.x, b.x), 2)')} AS v
            FROM kernels JOIN samples a ON a.id = i JOIN samples b ON b.id = j""",
        "sample_success": f"""
            WITH {_ALL}, {_SUCCESS} SELECT i AS id, {_rounded('p')} AS p FROM success""",
        "expected_correct": f"""
            WITH {_ALL}, {_SUCCESS} SELECT {_rounded('sum(p)')} AS f FROM success""",
        "nca_gradient": f"""
            WITH {_ALL}, {_GRADIENT} SELECT r, c, {_rounded('g')} AS g FROM gradient""",
        "nca_one_epoch": f"""
            WITH {_ALL}, {_GRADIENT}
            SELECT r, c, {_rounded(f'CASE WHEN r = c THEN 1.0 ELSE 0.0 END + {LR} * g')} AS a
            FROM gradient""",
        "nca_three_epochs": _epochs(3),
        "knn_predict": f"""
            WITH {_SAMPLES}, ranked AS (
              SELECT a.id, b.label, row_number() OVER (
                       PARTITION BY a.id ORDER BY round(list_distance(a.x, b.x), 9), b.id) AS place
              FROM samples a JOIN samples b ON a.id <> b.id),
            votes AS (
              SELECT id, label, count(*) AS n FROM ranked WHERE place <= 5 GROUP BY id, label),
            placed AS (
              SELECT id, label, row_number() OVER (
                       PARTITION BY id ORDER BY n DESC, label) AS place
              FROM votes)
            SELECT id, label AS predicted FROM placed WHERE place = 1""",
        "knn_queries": f"""
            WITH {_SAMPLES}, ranked AS (
              SELECT a.id, b.label, row_number() OVER (
                       PARTITION BY a.id ORDER BY round(list_distance(a.x, b.x), 9), b.id) AS place
              FROM samples a JOIN samples b ON a.id % 5 = 0 AND b.id % 5 <> 0),
            votes AS (
              SELECT id, label, count(*) AS n FROM ranked WHERE place <= 5 GROUP BY id, label),
            placed AS (
              SELECT id, label, row_number() OVER (
                       PARTITION BY id ORDER BY n DESC, label) AS place
              FROM votes)
            SELECT id, label AS predicted FROM placed WHERE place = 1""",
    }
