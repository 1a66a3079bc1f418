"""Inputs that used to give wrong numbers, and plans that used to gather rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.operators import blocks, skew
from quillmesh.operators import graph as graph_ops
from quillmesh.operators import pairs as pair_ops
from quillmesh.operators import samples as sample_ops
from quillmesh.plans import metric
from quillmesh.sources import keyed_table, matrices, scratch

ONE = np.eye(2)
PAIRS = "i STRING, j STRING, x ARRAY<DOUBLE>"


def executed_plans(spark, work):
    """The physical plans of the jobs that ``work`` runs, as far as actions show them."""
    seen = []
    frame = type(spark.range(0))
    collect, first = frame.collect, frame.first

    def noted(action):
        def run(self, *args):
            seen.append(self._jdf.queryExecution().executedPlan().toString())
            return action(self, *args)
        return run

    frame.collect, frame.first = noted(collect), noted(first)
    try:
        work()
    finally:
        frame.collect, frame.first = collect, first
    return "\n".join(seen)


def test_size_checks_and_splits_gather_no_rows(spark):
    rows = spark.range(10_000).selectExpr("id AS k", "cast(id AS string) AS v")
    plans = executed_plans(spark, lambda: (skew.is_small(rows), blocks.item_splits(rows.select("v"), 8)))
    assert "Aggregate" in plans
    assert "TakeOrdered" not in plans
    assert not [x for x in plans.split("\n") if "LocalLimit" in x and "LocalLimit 1\n" not in x + "\n"
                and not x.strip().endswith("LocalLimit 1")]


@pytest.mark.parametrize("small", [True, False])
def test_a_repeated_label_raises(spark, monkeypatch, small):
    monkeypatch.setattr(pair_ops, "is_small", lambda rows: small)
    pairs = spark.createDataFrame([("a", "b", [1.0, 0.0]), ("b", "a", [-1.0, 0.0])], PAIRS)
    labels = spark.createDataFrame([("a", "0"), ("b", "0"), ("b", "1")], "id STRING, label STRING")
    for work in (metric.pair_success, pair_ops.pair_gradient):
        with pytest.raises(Exception, match="more than one label for sample b"):
            work(pairs, labels, ONE).collect()


@pytest.mark.parametrize("x, said", [([1.0], "differ in length"), ([1.0, 2.0, 3.0], "differ in length"),
                                     (None, "is null"), ([1.0, None], "is null")])
def test_ragged_and_null_vectors_raise(spark, x, said):
    pairs = spark.createDataFrame([("a", "b", [1.0, 0.0]), ("b", "a", x)], PAIRS).coalesce(1)
    with pytest.raises(Exception, match=said):
        pair_ops.pair_kernels(pairs, ONE).collect()


def test_null_components_of_samples_raise(spark):
    samples = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, None])], "id INT, x ARRAY<DOUBLE>")
    labels = spark.createDataFrame([(1, 0), (2, 0)], "id INT, label INT")
    with pytest.raises(Exception, match="is null"):
        metric.sample_success(samples, labels).collect()


def test_ranges_cover_both_ends(spark):
    edges = spark.range(4000).selectExpr("id AS src", "id % 10 + 5000 AS dst")
    ends = graph_ops.both_directions(graph_ops.simple_edges(edges))

    splits = blocks.item_splits(edges.select(F.explode(F.array("src", "dst")).alias("v")), 16)
    counts = [r["count"] for r in blocks.with_range(ends, "neighbour", splits).groupBy(blocks.RANGE).count().collect()]
    assert max(counts) <= 4 * sum(counts) / 16


def test_an_unfinished_put_blocks_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    os.makedirs(f"{path}/version=1")
    assert list(keyed_table._versions(spark, path)) == []
    rows = spark.createDataFrame([("a", 1.0)], "word STRING, avg_count DOUBLE")
    assert keyed_table.put_rows(rows, path, "word") == 2
    assert [tuple(r) for r in keyed_table.scan_rows(spark, path).collect()] == [("a", 1.0)]
    assert "Exchange" not in keyed_table.scan_rows(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_pair_training_goes_on_from_a_matrix(spark):
    pairs = spark.createDataFrame([("a", "b", [1.0]), ("b", "a", [-1.0]), ("a", "c", [2.0]), ("c", "a", [-2.0])], PAIRS)
    labels = spark.createDataFrame([("a", "0"), ("b", "0"), ("c", "1")], "id STRING, label STRING")
    whole = metric.nca_fit_pairs(pairs, labels, 1, 0.1, 2)
    rest = metric.nca_fit_pairs(pairs, labels, 1, 0.1, 1, matrix=whole[1])
    assert rest[1] == pytest.approx(whole[2])


def test_scratch_tables(spark, tmp_path):
    kept = scratch.keep(spark.range(5), "five", str(tmp_path))
    assert kept.count() == 5 and os.listdir(tmp_path)[0].startswith("five-")




def test_copies_of_a_block_follow_the_tasks_not_the_samples():
    for tasks in (8, 200, 20_000):
        groups = [sample_ops.group_count(blocks, tasks) for blocks in (10**3, 10**5, 10**7)]
        assert max(groups) <= 2 * tasks**0.5 + 1
        assert groups[1] == groups[2]


@pytest.mark.parametrize("blocks", [1, 2, 7, 12])
def test_every_two_blocks_meet_in_one_cell(spark, blocks):
    rows = spark.range(200).select("id", F.lit("a").alias("label"), F.array(F.lit(1.0)).alias("x"))
    cells = sample_ops.block_cells(rows, blocks).select(
        F.explode("own.id").alias("i"), "other.id", "diagonal")
    met = cells.select("i", F.explode("id").alias("j"), "diagonal")
    found = [(min(r.i, r.j), max(r.i, r.j)) for r in met.collect() if not r.diagonal or r.i <= r.j]
    assert sorted(found) == [(i, j) for i in range(200) for j in range(i, 200)]


def test_a_cut_training_goes_on(spark, tmp_path):
    pairs = [("a", "b", [1.0, 0.0]), ("a", "c", [0.0, 1.0]), ("b", "a", [-1.0, 0.0]),
             ("b", "c", [-1.0, 1.0]), ("c", "a", [0.0, -1.0]), ("c", "b", [1.0, -1.0])]
    rows = spark.createDataFrame(pairs, "i STRING, j STRING, x ARRAY<DOUBLE>")
    labels = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2")], "id STRING, label STRING")
    path = str(tmp_path / "model")
    whole = metric.nca_fit_pairs(rows, labels, 2, 0.1, 3)
    matrices.save_epoch(spark, 0, whole[0], path)
    seen = []
    metric.nca_fit_pairs(rows, labels, 2, 0.1, 2, each=seen.append)
    for epoch, matrix in enumerate(seen, 1):
        matrices.save_epoch(spark, epoch, matrix, path)
    assert matrices.last_epoch(spark, path) == 2
    more = metric.nca_fit_pairs(rows, labels, 2, 0.1, 1, matrix=matrices.load_model(spark, path))
    assert np.allclose(more[-1], whole[-1]) and not np.allclose(whole[-1], whole[0])


@pytest.mark.parametrize("value", [
    "array_repeat(named_struct('a', id, 'b', id, 'c', id, 'd', id, 'e', id), 7000)",
    "cast(repeat('x', 400000) AS BINARY)",
    "array(repeat('x', 400000))",
    "named_struct('a', 1, 'b', array(cast(repeat('x', 400000) AS BINARY)))",
    "map(id, repeat('x', 400000))",
])
def test_lookups_are_weighed_by_what_they_hold(spark, value):
    """1,000 rows of 280 MB or 400 MB together, and ten of them."""
    rows = spark.range(1000).selectExpr("id", f"{value} AS v")
    assert not skew.is_small(rows)
    assert skew.is_small(rows.where("id < 10"))
    assert skew.is_small(rows.selectExpr("id", "CASE WHEN id < 5 THEN v END AS v"))
