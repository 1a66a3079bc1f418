import numpy as np
import pytest

from quillmesh.operators import samples as ops
from quillmesh.operators.balls import KERNEL_REACH, balls_of
from quillmesh.plans import metric


def made(spark, seed, clusters, spread, n=400, d=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (clusters, d))
    x = centres[rng.integers(clusters, size=n)] + rng.normal(0, 1, (n, d))
    label = rng.integers(0, 3, n)
    rows = [(i, [float(v) for v in row], int(label[i])) for i, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "id BIGINT, x ARRAY<DOUBLE>, label INT").repartition(4).cache()
    return x, label, frame.select("id", "x"), frame.select("id", "label")


def brute_success(x, label):
    squares = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    k = np.exp(-squares)
    np.fill_diagonal(k, 0.0)
    z, s = k.sum(axis=1), (k * (label[:, None] == label[None])).sum(axis=1)
    return np.divide(s, z, out=np.zeros_like(z), where=z > 0)


@pytest.mark.parametrize("clusters, spread", [(8, 60.0), (1, 1.0), (400, 300.0)])
def test_pruned_sums_equal_all(spark, clusters, spread):
    x, label, samples, labels = made(spark, 3, clusters, spread)
    got = {r.id: r.p for r in metric.sample_success(samples, labels).collect()}
    want = brute_success(x, label)
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-9)
    blocks = ops.block_count(samples, len(x), 3)
    rows = samples.join(labels, "id")
    successes = ops.success(ops.kernel_sums(rows, np.eye(3), blocks))
    balls = balls_of(samples, np.eye(3), blocks)
    gradients = [ops.gradient(rows, successes, np.eye(3), blocks, b) for b in (None, balls)]
    plain, pruned = ({(r.r, r.c): r.v for r in g.collect()} for g in gradients)
    assert plain.keys() == pruned.keys() and np.allclose(
        [plain[at] for at in plain], [pruned[at] for at in plain], atol=1e-6)


def test_far_blocks_never_meet(spark):
    """Eight clusters far apart: of the pairs of blocks only those within a cluster meet."""
    x, _, samples, labels = made(spark, 5, 8, 200.0)
    rows, blocks = samples.join(labels, "id"), 16
    balls = ops.kernel_balls(samples, np.eye(3), blocks)
    met = ops.ball_cells(rows, blocks, balls).selectExpr("size(own) a", "size(other) b", "diagonal").collect()
    pairs = sum(r.a * (r.a - 1) // 2 if r.diagonal else r.a * r.b for r in met)
    close = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= KERNEL_REACH ** 2
    assert (close.sum() - len(x)) // 2 <= pairs < len(x) * (len(x) - 1) // 2 / 4
    everything = ops.block_cells(rows, blocks).count()
    assert len(met) < everything / 2


def test_no_balls_where_all_are_near(spark):
    _, _, samples, _ = made(spark, 7, 4, 1.0)
    assert ops.kernel_balls(samples, np.eye(3), 8) is None


@pytest.mark.parametrize("clusters, spread, k", [(6, 80.0, 5), (1, 1.0, 3), (6, 80.0, 390)])
def test_nearest_of_queries(spark, clusters, spread, k):
    x, label, samples, labels = made(spark, 11, clusters, spread)
    x[:20] = x[20:40]  # ties
    samples = spark.createDataFrame([(i, x[i].tolist()) for i in range(len(x))], "id BIGINT, x ARRAY<DOUBLE>")
    got = metric.knn_predict_for(samples.where("id % 5 = 0"), samples.where("id % 5 <> 0"), labels, k)
    got = {r.id: r.predicted for r in got.collect()}
    others = [i for i in range(len(x)) if i % 5]
    for i in range(0, len(x), 5):
        away = np.round(np.sqrt(((x[others] - x[i]) ** 2).sum(axis=1)), 9)
        near = [others[j] for j in np.lexsort((others, away))[:k]]
        votes = np.bincount(label[near], minlength=3)
        assert got[i] == votes.argmax()
    assert len(got) == len(x) // 5


def test_queries_meet_few_balls(spark):
    _, _, samples, _ = made(spark, 13, 8, 200.0)
    balls = balls_of(samples, np.eye(3), 32)
    near = balls.measured(samples.where("id % 5 = 0").select("x")).nearest_within(balls, 3)
    assert near.sum() < near.size / 3
