import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmesh.operators import samples as ops
from quillmesh.plans import metric


def made(spark, n, d=3, seed=1, labels=3):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(labels)), rng.normal(0, 1, d).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "id BIGINT, label INT, x ARRAY<DOUBLE>")


def test_a_new_fit_sums_the_kernels_of_an_epoch_once(spark, tmp_path, monkeypatch):
    calls, sums = [], ops.kernel_sums
    monkeypatch.setattr(ops, "kernel_sums", lambda *args: calls.append(1) or sums(*args))
    rows = made(spark, 60)
    stored = metric.nca_fit_stored(rows, rows, 0.1, 1, str(tmp_path / "model"))
    assert len(calls) == 2 and stored.select("epoch").distinct().count() == 2


def test_copies_of_blocks_do_not_grow_with_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(ops, "_tasks", lambda samples: 5000)
    rows = made(spark, 200)
    cells = ops.block_cells(rows, 40).where("not diagonal")
    assert cells.count() == 40 * 39 // 2
    cores = spark.sparkContext.defaultParallelism
    assert ops._cell_tasks(rows, 40) == 4 * cores and ops._cell_tasks(rows, 10**6) == 5000


def test_vectors_travel_as_floats_only_where_that_loses_nothing(spark):
    for value, size in ((0.5, 4), (0.1, 8), (1e300, 8)):
        rows = spark.range(6).select("id", F.lit(1).alias("label"), F.array(F.lit(value), F.lit(2.0)).alias("x"))
        cell = ops.block_cells(rows, 1).first()
        assert len(cell.own_x) == 6 * 2 * size and cell.own_x == cell.other_x
        assert np.frombuffer(cell.own_x, dtype=f"f{size}").tolist() == [value, 2.0] * 6
    with pytest.raises(Exception, match="a vector or one of its components is null"):
        ops.block_cells(rows.withColumn("x", F.array(F.lit(None).cast("double"))), 1).count()


@pytest.mark.parametrize("furthest", [1e-9, 0.1, 4.0, 63.0, 750.0])
def test_exp_by_halving(furthest):
    t = -np.random.default_rng(2).random((40, 50)) * furthest
    halvings = ops._halvings(furthest)
    found = t * ops._exp_scale(halvings)
    ops._exp(found, halvings, np.empty_like(t), np.empty_like(t))
    assert np.allclose(found, np.exp(t), rtol=1e-15 * 2 ** halvings + 4e-15, atol=0)


@pytest.mark.parametrize("slow", [True, False])
@pytest.mark.parametrize("diagonal", [True, False])
@pytest.mark.parametrize("spread, labels", [(0.3, 3), (3.0, 150), (12.0, 1), (200.0, 4)])
def test_kernels_near_and_far(monkeypatch, slow, diagonal, spread, labels):
    """Sums and folds against those of every pair: all kernels above 0, some, hardly any."""
    monkeypatch.setattr(ops, "SLOW_EXP", slow)
    rng = np.random.default_rng(3)

    def block(n, first):
        x = rng.normal(0, 0.3, (n, 4)) + spread * rng.integers(-1, 2, (n, 4))
        return {"id": pa.array(np.arange(first, first + n)), "x": x, "z": rng.random(n), "p": rng.random(n),
                "label": pa.array([str(v) for v in rng.integers(0, labels, n)])}

    own = block(150, 0)
    other = own if diagonal else block(90, 150)
    away = own["x"][:, None] - other["x"][None]
    k = np.exp(-(away ** 2).sum(axis=2))
    if diagonal:
        np.fill_diagonal(k, 0.0)
    same = np.array(own["label"].to_pylist())[:, None] == np.array(other["label"].to_pylist())[None]
    rows, columns = ops._cell_sums(own, other, np.eye(4), diagonal)
    assert np.allclose(rows, [k.sum(axis=1), (k * same).sum(axis=1)], rtol=1e-9, atol=1e-300)
    assert np.allclose(columns, [k.sum(axis=0), (k * same).sum(axis=0)], rtol=1e-9, atol=1e-300)
    v = k * (own["p"][:, None] - same) / own["z"][:, None]
    if not diagonal:
        v += k * (other["p"][None] - same) / other["z"][None]
    assert np.allclose(ops._cell_fold(own, other, np.eye(4), diagonal),
                       np.einsum("ij,ijr,ijc->rc", v, away, away), rtol=1e-8, atol=1e-8)


def brute_nearest(x, k, digits=9):
    """[(distance, id), ...] of the k nearest others to each row of x, NaN last."""
    found = []
    for i in range(len(x)):
        away = x - x[i]
        away = np.round(np.sqrt(np.einsum("nd,nd->n", away, away)), digits)
        order = [int(j) for j in np.lexsort((np.arange(len(x)), away)) if j != i][:k]
        found.append([(float(away[j]), j) for j in order])
    return found


def clouds():
    rng = np.random.default_rng(5)
    yield "plain", rng.normal(0, 1, (500, 16)), 5
    yield "ties", np.round(rng.normal(0, 1, (600, 2))), 4
    yield "fewer than k", rng.normal(0, 1, (6, 3)), 9
    copies = rng.normal(0, 1, (700, 8))
    copies[:400] = copies[0]
    copies[500:550] = copies[500] + 1e-7 * rng.normal(0, 1, (50, 8))
    yield "copies and near copies", copies, 5
    yield "far off", rng.normal(0, 1, (400, 8)) + 1e6, 3
    yield "two far clusters", 1e-6 * rng.normal(0, 1, (400, 8)) + 1e4 * (np.arange(400)[:, None] % 2), 3
    yield "huge", 1e20 * rng.normal(0, 1, (300, 4)), 3
    holes = rng.normal(0, 1, (300, 4))
    holes[[3, 77]] = np.nan
    yield "not a number", holes, 3


@pytest.mark.parametrize("x, k", [pytest.param(x, k, id=name) for name, x, k in clouds()])
def test_screened_neighbours_are_those_of_all_pairs(x, k):
    order = np.random.default_rng(6).permutation(len(x))
    ids = [np.sort(part) for part in np.array_split(order, min(4, len(x)))]
    blocks = [{"id": pa.array(part), "label": pa.array(part % 7), "x": x[part]} for part in ids]
    kept = [ops._Nearest(block, k) for block in blocks]
    for i in range(len(blocks)):
        for j in range(i, len(blocks)):
            ops._compare(kept[i], blocks[i]["x"], kept[j], blocks[j]["x"], 9)
    want, found = brute_nearest(x, k), {}
    for r in (r for block in kept for r in block.best().to_pylist()):
        assert r["label"] == r["neighbour"] % 7
        found.setdefault(r["id"], []).append((r["distance"], r["neighbour"]))
    for i in range(len(x)):
        near = sorted(found[i], key=lambda pair: (np.nan_to_num(pair[0], nan=np.inf), pair[1]))
        assert str(near) == str(want[i])


def test_few_pairs_of_two_blocks_are_worked_out(monkeypatch):
    rng, worked = np.random.default_rng(7), []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda *args: worked.append(len(args[1])) or einsum(*args))
    blocks = [{"id": pa.array(np.arange(at, at + 1024)), "label": pa.array(np.zeros(1024, dtype=int)),
               "x": rng.normal(0, 1, (1024, 16))} for at in (0, 1024)]
    own, other = (ops._Nearest(block, 5) for block in blocks)
    ops._compare(own, blocks[0]["x"], other, blocks[1]["x"], 9)
    assert 2 * 5 * 1024 <= 2 * sum(worked) < 1024 * 1024 / 10


def test_equal_vectors_are_nearest_and_go_by_id(spark):
    """Copies of a vector are 0 apart, in whatever blocks they are."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (130, 64))
    x = np.concatenate([x, x, x, x])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = rng.integers(0, 4, len(x))
    rows = spark.createDataFrame([(i, int(label[i]), x[i].tolist()) for i in range(len(x))],
                                 "id BIGINT, label INT, x ARRAY<DOUBLE>")
    got = {r.id: r.predicted for r in metric.knn_predict(rows, rows, 1).collect()}
    assert got == {i: label[i % 130 if i >= 130 else i + 130] for i in range(len(x))}
