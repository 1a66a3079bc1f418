"""Command line: ``spark-submit ... -m quillmesh <job> <arguments>``.

Inputs and outputs are paths; text goes in and comes out as plain lines.
"""

from __future__ import annotations

import argparse
from itertools import count

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import text as text_ops
from .operators.graph import MODES
from .plans import graph, metric, text
from .sources import keyed_table
from .sources import text as files
from .sources.delimited import read_delimited
from .sources.matrices import last_epoch, load_model, save_epoch

AVERAGES = "word STRING, count DOUBLE"


def word_count(spark, a):
    counts = text.word_count(files.read_lines(spark, a.input), "value")
    files.write_key_values(counts, a.output, F.col("word"), F.col("n"))


def inverted_index(spark, a):
    names = files.read_document_names(spark, a.input)
    index = text.inverted_index(files.read_documents(spark, a.input), a.block, names=names)
    files.write_key_values(text.index_lines(index), a.output, F.col("key"), F.col("value"))


def count_sort(spark, a):
    files.write_values(text.sort_index_lines(files.read_lines(spark, a.input)), a.output,
                       F.col("value"))


def tf_idf(spark, a):
    weights = text.tf_idf_from_lines(
        files.read_key_values(spark, a.index), files.read_document_list(spark, a.documents)
    )
    key = F.concat("author", F.lit(", "), "term")
    files.write_key_values(weights, a.output, key, F.col("tf_idf"))


def store_index(spark, a):
    names = files.read_document_names(spark, a.input)
    text.store_index(files.read_documents(spark, a.input), a.table, a.output, names)


def export_averages(spark, a):
    keyed_table.export_rows(spark, a.table, a.output)


def _exported(spark, path):
    schema = spark.createDataFrame([], AVERAGES).schema
    return read_delimited(spark, path, schema).toDF("term", "avg_count")


def frequent_words(spark, a):
    found = text_ops.above_average(_exported(spark, a.input), a.threshold)
    files.write_key_values(found, a.output, F.col("term"), F.col("avg_count"))


def top_words(spark, a):
    found = text_ops.top_averages(_exported(spark, a.input), a.k)
    files.write_key_values(found, a.output, F.col("term"), F.col("avg_count"))


def adjacency(spark, a):
    lists = graph.adjacency(files.read_edges(spark, a.input), a.mode, a.block)
    files.write_key_values(graph.adjacency_lines(lists), a.output, F.col("key"), F.col("value"))


def triangle_count(spark, a):
    edges = graph.edges_of(files.read_adjacency(spark, a.input))
    files.write_values(graph.triangle_count(edges), a.output, F.col("n"))


def triangles(spark, a):
    counted = graph.triangle_count(files.read_edges(spark, a.input), a.mode)
    files.write_values(counted, a.output, F.col("n"))


def nca(spark, a):
    labels = files.read_labels(spark, a.labels)
    done, matrix = 0, np.eye(a.dim)
    if a.resume:
        done = last_epoch(spark, a.output)
        matrix = load_model(spark, a.output, done)
    else:
        save_epoch(spark, 0, matrix, a.output, "overwrite")
    numbers = count(done + 1)
    history = metric.nca_fit_pairs(
        files.read_pairs(spark, a.pairs), labels, a.dim, a.lr, a.epochs - done, a.tol, matrix,
        lambda learned: save_epoch(spark, next(numbers), learned, a.output),
    )
    for row in np.asarray(history[-1]):
        print(" ".join(repr(float(v)) for v in row))


def _learned(spark, a):
    return load_model(spark, a.model, last_epoch(spark, a.model) if a.epoch is None else a.epoch)


def pair_probabilities(spark, a):
    found = metric.pair_probabilities(files.read_pairs(spark, a.pairs), _learned(spark, a))
    files.write_key_values(found, a.output, F.concat("i", F.lit(","), "j"), F.col("p"))


def pair_success(spark, a):
    pairs, labels = files.read_pairs(spark, a.pairs), files.read_labels(spark, a.labels)
    found = metric.pair_success(pairs, labels, _learned(spark, a))
    files.write_key_values(found, a.output, F.col("i"), F.col("p"))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quillmesh", description=__doc__)
    jobs = top.add_subparsers(required=True, metavar="job")

    def job(run, *places):
        made = jobs.add_parser(run.__name__.replace("_", "-"))
        made.set_defaults(run=run)
        for place in places:
            made.add_argument(place)
        return made

    job(word_count, "input", "output")
    job(inverted_index, "input", "output").add_argument("--block", type=int, default=10_000)
    job(count_sort, "input", "output")
    job(tf_idf, "documents", "index", "output")
    job(store_index, "input", "table", "output")
    job(export_averages, "table", "output")
    job(frequent_words, "input", "output").add_argument("--threshold", type=float, default=300.0)
    job(top_words, "input", "output").add_argument("--k", type=int, default=100)
    lists = job(adjacency, "input", "output")
    lists.add_argument("mode", choices=MODES)
    lists.add_argument("--block", type=int, default=10_000)
    job(triangle_count, "input", "output")
    job(triangles, "input", "output").add_argument("mode", choices=MODES)
    training = job(nca, "pairs", "labels", "output")
    training.add_argument("dim", type=int)
    training.add_argument("lr", type=float)
    training.add_argument("epochs", type=int)
    training.add_argument("--tol", type=float)
    training.add_argument("--resume", action="store_true",
                          help="go on from the last epoch that the output holds")
    for after in (job(pair_probabilities, "pairs", "model", "output"),
                  job(pair_success, "pairs", "labels", "model", "output")):
        after.add_argument("--epoch", type=int, help="of the model; the last by default")
    return top


def main(arguments: list | None = None) -> None:
    a = parser().parse_args(arguments)
    a.run(SparkSession.builder.appName("quillmesh").getOrCreate(), a)


if __name__ == "__main__":
    main()
