import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.functions import vectors
from quillmesh.operators import pairs as pair_ops
from quillmesh.operators import samples as sample_ops
from quillmesh.operators import skew
from quillmesh.plans import metric

ONE = np.eye(1)


def dense(x, label, a):
    """Kernel, probabilities, success and gradient worked out pair by pair."""
    n = len(x)
    k = np.array([[0.0 if i == j else np.exp(-np.sum((a @ (x[i] - x[j])) ** 2))
                   for j in range(n)] for i in range(n)])
    z = k.sum(axis=1)
    p = np.divide(k, z[:, None], out=np.zeros_like(k), where=k != 0)
    same = label[:, None] == label[None, :]
    success = (p * same).sum(axis=1)
    total = sum(
        p[i, j] * (success[i] - same[i, j]) * np.outer(x[i] - x[j], x[i] - x[j])
        for i in range(n) for j in range(n)
    )
    return k, p, success, a @ total


@pytest.fixture(scope="module")
def line(spark):
    """x = 0, 1, 2 with labels 0, 0, 1."""
    samples = spark.createDataFrame(
        [("a", [0.0]), ("b", [1.0]), ("c", [2.0])], "id STRING, x ARRAY<DOUBLE>"
    )
    labels = spark.createDataFrame([("a", "0"), ("b", "0"), ("c", "1")], "id STRING, label STRING")
    return samples, labels, all_pairs(samples)


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 4)) * 0.7 + 30.0
    label = rng.integers(0, 3, size=150)
    samples = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(x)], "id BIGINT, x ARRAY<DOUBLE>"
    )
    labels = spark.createDataFrame(
        [(i, int(v)) for i, v in enumerate(label)], "id BIGINT, label INT"
    )
    return x, label, samples, labels


def all_pairs(samples):
    ids = [r.id for r in samples.select("id").collect()]
    kind = samples.schema["id"].dataType.simpleString()
    links = samples.sparkSession.createDataFrame(
        [(i, j) for i in ids for j in ids], f"i {kind}, j {kind}"
    )
    return pair_ops.difference_pairs(samples, links)


def matrix(df, d):
    out = np.zeros((d, d))
    for r in df.collect():
        out[r.r, r.c] = r.v
    return out


def test_pair_kernel_and_probabilities(line):
    _, _, pairs = line
    kernels = pair_ops.pair_kernels(pairs, ONE).drop("x")
    p = {(r.i, r.j): r.p for r in pair_ops.pair_probabilities(kernels).collect()}
    assert len(p) == 9
    expected = {("a", "b"): 0.952574, ("a", "c"): 0.047426, ("b", "a"): 0.5, ("b", "c"): 0.5,
                ("c", "a"): 0.047426, ("c", "b"): 0.952574}
    for key, value in p.items():
        assert value == pytest.approx(expected.get(key, 0.0), abs=1e-6)


def test_success_and_objective(line):
    samples, labels, pairs = line
    expected = {"a": 0.952574, "b": 0.5, "c": 0.0}
    from_pairs = {r.i: r.p for r in metric.pair_success(pairs, labels, ONE).collect()}
    found = metric.sample_success(samples, labels)
    from_samples = {r.id: r.p for r in found.collect()}
    for got in (from_pairs, from_samples):
        assert got == {k: pytest.approx(v, abs=1e-6) for k, v in expected.items()}
    assert metric.expected_correct(found).first().f == pytest.approx(1.452574, abs=1e-6)


def test_gradient_and_one_step(line):
    samples, labels, pairs = line
    for got in (metric.nca_gradient(samples, labels), pair_ops.pair_gradient(pairs, labels, ONE)):
        assert matrix(got, 1)[0, 0] == pytest.approx(0.135530, abs=1e-6)
    for history in (metric.nca_fit(samples, labels, 0.1, 1),
                    metric.nca_fit_pairs(pairs, labels, 1, 0.1, 1)):
        assert history[0][0, 0] == 1.0
        assert history[1][0, 0] == pytest.approx(1.013553, abs=1e-6)


def test_against_pair_by_pair_sums(cloud):
    x, label, samples, labels = cloud
    a = np.eye(4) + 0.1 * np.arange(16).reshape(4, 4) / 16
    _, _, success, gradient = dense(x, label, a)
    got = {r.id: r.p for r in metric.sample_success(samples, labels, a).collect()}
    assert np.allclose([got[i] for i in range(150)], success, atol=1e-9)
    assert np.allclose(matrix(metric.nca_gradient(samples, labels, a), 4), gradient, atol=1e-8)


@pytest.mark.parametrize("blocks", [1, 2, 5, 8])
def test_every_number_of_blocks_meets_each_pair_once(cloud, blocks):
    x, label, samples, labels = cloud
    rows, _, _ = sample_ops.labelled_samples(samples, labels)
    k, _, success, gradient = dense(x, label, np.eye(4))
    sums = sample_ops.kernel_sums(rows, np.eye(4), blocks)
    z = {r.id: r.z for r in sums.collect()}
    assert np.allclose([z[i] for i in range(150)], k.sum(axis=1), atol=1e-9)
    got = sample_ops.gradient(rows, sample_ops.success(sums), np.eye(4), blocks)
    assert np.allclose(matrix(got, 4), gradient, atol=1e-8)


def test_gradient_is_half_the_slope_and_training_climbs(cloud):
    x, label, samples, labels = cloud
    history = metric.nca_fit(samples, labels, 0.02, 2)
    f = [dense(x, label, a)[2].sum() for a in history]
    assert f[0] < f[1] < f[2]
    step, at = 1e-5, np.zeros((4, 4))
    at[1, 2] = step
    slope = (dense(x, label, np.eye(4) + at)[2].sum() - dense(x, label, np.eye(4) - at)[2].sum())
    slope /= 2 * step
    assert 2 * (history[1] - history[0])[1, 2] / 0.02 == pytest.approx(slope, rel=1e-4)


def test_tolerance_ends_training(line):
    samples, labels, _ = line
    assert len(metric.nca_fit(samples, labels, 0.1, 5, tol=1.0)) == 2
    assert len(metric.nca_fit(samples, labels, 0.1, 3, tol=1e-9)) == 4


def test_underflow_gives_zeros(spark):
    samples = spark.createDataFrame([(0, [0.0]), (1, [100.0])], "id INT, x ARRAY<DOUBLE>")
    labels = spark.createDataFrame([(0, 0), (1, 0)], "id INT, label INT")
    assert {r.p for r in metric.sample_success(samples, labels).collect()} == {0.0}
    assert matrix(metric.nca_gradient(samples, labels), 1)[0, 0] == 0.0
    pairs = all_pairs(samples)
    assert {r.p for r in metric.pair_success(pairs, labels, ONE).collect()} == {0.0}
    assert matrix(pair_ops.pair_gradient(pairs, labels, ONE), 1)[0, 0] == 0.0


def test_bad_inputs_raise(line, spark):
    samples, labels, pairs = line
    few = labels.where("id <> 'c'")
    with pytest.raises(ValueError, match="1 samples have no label"):
        metric.sample_success(samples, few)
    with pytest.raises(Exception, match="no label for a sample of pair"):
        metric.pair_success(pairs, few, ONE).collect()
    with pytest.raises(ValueError, match="repeat"):
        metric.sample_success(samples.union(samples), labels)
    ragged = samples.union(spark.createDataFrame([("d", [1.0, 2.0])], samples.schema))
    with pytest.raises(ValueError, match="length"):
        metric.sample_success(ragged, labels.union(spark.createDataFrame([("d", "0")], labels.schema)))
    with pytest.raises(ValueError, match="no samples"):
        metric.sample_success(samples.where("false"), labels)


def test_large_lookups_give_the_same(line, monkeypatch):
    samples, labels, pairs = line
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    again = all_pairs(samples)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, pairs.collect()))
    got = pair_ops.pair_gradient(again, labels, ONE)
    assert matrix(got, 1)[0, 0] == pytest.approx(0.135530, abs=1e-6)
    with pytest.raises(Exception, match="no label for a sample of pair"):
        metric.pair_success(again, labels.where("id <> 'c'"), ONE).collect()


def test_label_with_one_member_counts_nothing(line):
    samples, labels, _ = line
    assert {r.id: r.p for r in metric.sample_success(samples, labels).collect()}["c"] == 0.0


def test_pairs_count_only_as_given(line):
    """Without the pair (b, c), b is sure to pick a."""
    _, labels, pairs = line
    fewer = pairs.where("not (i = 'b' and j = 'c')")
    assert {r.i: r.p for r in metric.pair_success(fewer, labels, ONE).collect()}["b"] == 1.0


@pytest.mark.parametrize("most", [10, 500_000])
def test_hot_sample_in_a_pair_table(spark, monkeypatch, most):
    """One i holds most pairs; salted or not, its rows sum up whole."""
    monkeypatch.setattr(skew, "BROADCAST_ROWS", most)
    n = 2000
    links = [(0, j) for j in range(n)] + [(i, 0) for i in range(1, n)]
    pairs = spark.createDataFrame(
        [(i, j, [(i - j) / n]) for i, j in links], "i BIGINT, j BIGINT, x ARRAY<DOUBLE>"
    )
    kernels = pair_ops.pair_kernels(pairs, ONE)
    found = pair_ops.pair_probabilities(kernels)
    assert found.count() == len(links)
    sums = {r.i: r.s for r in found.groupBy("i").agg(F.sum("p").alias("s")).collect()}
    assert len(sums) == n and all(v == pytest.approx(1.0) for v in sums.values())


def test_combine_keeps_only_shared_keys(spark):
    left = spark.createDataFrame([(0, 1, 2.0), (0, 2, 3.0)], "i INT, j INT, v DOUBLE")
    right = spark.createDataFrame([(0, 1, 5.0), (9, 9, 1.0)], "i INT, j INT, v DOUBLE")
    minus = pair_ops.combine(left, right, ["i", "j"], F.col("left.v") - F.col("right.v"))
    assert [tuple(r) for r in minus.collect()] == [(0, 1, -3.0)]
    per_i = spark.createDataFrame([(0, 10.0)], "i INT, w DOUBLE")
    times = pair_ops.combine(left, per_i, "i", F.col("left.v") * F.col("right.w"), keep=("j",))
    assert sorted(tuple(r) for r in times.collect()) == [(0, 1, 20.0), (0, 2, 30.0)]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0])], "x ARRAY<DOUBLE>, y ARRAY<DOUBLE>")
    x, y = F.col("x"), F.col("y")
    row = df.select(
        vectors.subtract(x, y).alias("sub"),
        vectors.scale(F.lit(2.0), x).alias("scale"),
        vectors.dot(x, y).alias("dot"),
        vectors.outer(x, y).alias("outer"),
        vectors.apply_matrix([[1, 1], [0, 2]], x).alias("moved"),
        vectors.pair_kernel(F.lit(1), F.lit(2), vectors.subtract(x, y)).alias("k"),
        vectors.pair_kernel(F.lit(1), F.lit(1), x).alias("self"),
        vectors.divide_or_zero(F.lit(0.0), F.lit(0.0)).alias("zero"),
        vectors.divide_or_zero(F.lit(1.0), F.lit(4.0)).alias("quarter"),
    ).first()
    assert row["sub"] == [2.0, 2.0] and row["scale"] == [6.0, 8.0] and row["dot"] == 11.0
    assert row["outer"] == [[3.0, 6.0], [4.0, 8.0]] and row["moved"] == [7.0, 8.0]
    assert row["k"] == pytest.approx(np.exp(-8.0)) and row["self"] == 0.0
    assert row["zero"] == 0.0 and row["quarter"] == 0.25


def test_nearest_neighbour_vote(cloud):
    x, label, samples, labels = cloud
    distance = np.round(np.linalg.norm(x[:, None] - x[None, :], axis=2), 9)
    expected = {}
    for i in range(len(x)):
        near = sorted((distance[i, j], j) for j in range(len(x)) if j != i)[:5]
        votes = [label[j] for _, j in near]
        expected[i] = min(set(votes), key=lambda v: (-votes.count(v), v))
    got = metric.knn_predict(samples, labels, 5)
    assert {r.id: r.predicted for r in got.collect()} == expected


def test_nearest_neighbour_ties_go_by_id_then_label(spark):
    samples = spark.createDataFrame(
        [("m", [0.0]), ("a", [1.0]), ("b", [-1.0]), ("z", [5.0])], "id STRING, x ARRAY<DOUBLE>"
    )
    labels = spark.createDataFrame(
        [("m", "y"), ("a", "q"), ("b", "p"), ("z", "q")], "id STRING, label STRING"
    )
    one = {r.id: r.predicted for r in metric.knn_predict(samples, labels, 1).collect()}
    assert one["m"] == "q"
    two = {r.id: r.predicted for r in metric.knn_predict(samples, labels, 2).collect()}
    assert two["m"] == "p"
    assert len(metric.knn_predict(samples, labels, 50).collect()) == 4
