from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.operators import pairs as pair_ops
from quillmesh.operators.skew import dealt_in_grid
from quillmesh.plans import metric
from quillmesh.sources import matrices
from quillmesh.sources import text as files


def keyed(spark, rows):
    return spark.createDataFrame(rows, "i BIGINT, k DOUBLE").repartition(4)


def test_combine_with_a_key_that_holds_half_of_both_sides(spark):
    left = [(0, float(n)) for n in range(1500)] + [(n, 1.0) for n in range(1, 1500)]
    right = [(0, float(n)) for n in range(200)] + [(n, 2.0) for n in range(1000, 1200)]
    right += [(5, 3.0), (5, 3.0), (None, 1.0)]
    a, b = keyed(spark, left), keyed(spark, right).withColumnRenamed("k", "d")
    found = pair_ops.combine(a, b, "i", F.col("left.k") * F.col("right.d"))
    want = Counter()
    held = {}
    for key, value in right:
        held.setdefault(key, []).append(value)
    for key, value in left:
        want.update((key, value * other) for other in held.get(key, []))
    assert Counter(map(tuple, found.collect())) == want
    dealt = dealt_in_grid(a, b, ["i"])
    cells = dealt[0].join(dealt[1], ["i", *dealt[2]]).groupBy("i", *dealt[2]).count()
    sizes = sorted(r["count"] for r in cells.where("i = 0").collect())
    assert len(sizes) >= 60 and sizes[-1] < 3 * 1500 * 200 / 64


def test_combine_with_a_key_that_is_hot_on_one_side_and_nulls(spark):
    left = [(7, float(n)) for n in range(3000)] + [(None, 1.0)]
    right = [(n, float(n)) for n in range(20)] + [(None, 2.0)]
    a, b = keyed(spark, left), keyed(spark, right).withColumnRenamed("k", "d")
    for x, y in ((a, b), (b.withColumnRenamed("d", "k"), a.withColumnRenamed("k", "d"))):
        found = pair_ops.combine(x, y, ["i"], F.col("left.k") + F.col("right.d"))
        assert sorted(r.v for r in found.collect()) == [n + 7.0 for n in range(3000)]
    empty = keyed(spark, [])
    assert pair_ops.combine(a, empty.withColumnRenamed("k", "d"), "i", F.col("left.k")).count() == 0


def test_packed_matrices_are_one_row_a_task(spark):
    def parts(batches):
        for batch in batches:
            pass
        yield pair_ops.packed_batch(np.arange(6.0).reshape(2, 3))

    made = spark.range(0, 100, 1, 7).mapInArrow(parts, pair_ops.PACKED)
    assert made.count() == 7
    found = {(r.r, r.c): r.v for r in pair_ops.summed_matrices(made, (2, 3)).collect()}
    assert found == {(r, c): 7.0 * (3 * r + c) for r in range(2) for c in range(3)}


@pytest.mark.parametrize("split", [None, "200"])
def test_lines_keep_their_order_through_files(spark, tmp_path, split):
    rng = np.random.default_rng(3)
    numbers = [int(n) for n in rng.integers(0, 10 ** 6, 5000)]
    path = str(tmp_path / "sorted")
    df = spark.createDataFrame([(n,) for n in numbers], "n BIGINT").repartition(5)
    files.write_ordered(df, path, F.concat(F.lit("n="), "n"), F.col("n"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)  # many splits of a file
        found = sorted(map(tuple, files.read_ordered(spark, path).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == [(at, f"n={n}") for at, n in enumerate(sorted(numbers), 1)]


def test_a_fit_goes_on_from_what_is_stored(spark, tmp_path):
    rng = np.random.default_rng(5)
    points = [(i, [float(v) for v in rng.normal(i % 3, 0.7, 4)], i % 3) for i in range(60)]
    table = spark.createDataFrame(points, "id BIGINT, x ARRAY<DOUBLE>, label INT")
    samples, labels = table.select("id", "x"), table.select("id", "label")
    path = str(tmp_path / "model")
    metric.nca_fit_stored(samples, labels, 0.05, 1, path)
    assert matrices.last_epoch(spark, path) == 1
    got = metric.nca_fit_stored(samples, labels, 0.05, 3, path).collect()
    history = metric.nca_fit(samples, labels, 0.05, 3)
    assert len(got) == 4 * 16
    for r in got:
        assert r.v == pytest.approx(history[r.epoch][r.r, r.c], abs=1e-9)
    for epoch, a in enumerate(history):
        f = metric.expected_correct(metric.sample_success(samples, labels, a)).first().f
        assert {round(r.f, 9) for r in got if r.epoch == epoch} == {round(f, 9)}
    # Fewer epochs than are stored: nothing is run again.
    assert metric.nca_fit_stored(samples, labels, 0.05, 2, path).count() == 3 * 16
