import io
import random
import time
import tracemalloc
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pytest

from quillmesh.operators import blocks, samples
from quillmesh.operators import text as ops
from quillmesh.plans import text
from quillmesh.sources import keyed_table


def many_documents(count):
    rng = random.Random(11)
    names = [f"w{i}" for i in range(40)] + ["É", "é", "日本", "a\x0bb", "😀"]
    rows = [(f"d{i}", " ".join(rng.choices(names, k=rng.randrange(30))) + "\n\tThe END ") for i in range(count)]
    return [*rows, ("d7", "the the again"), ("e", None), ("f", ""), ("g", " \n "), ("h", "The")]


@pytest.mark.parametrize("size", [3, 10_000])
@pytest.mark.parametrize("ranges", [1, 7])
def test_whole_documents_give_the_index_of_their_lines(spark, monkeypatch, size, ranges):
    docs = spark.createDataFrame(many_documents(150), "doc STRING, text STRING").repartition(5)
    want = sorted(map(tuple, text.inverted_index(docs, size=size, ranges=ranges).collect()))
    for chunk, long in ((1 << 20, 100_000), (400, 5)):
        monkeypatch.setattr(ops, "CHUNK_BYTES", chunk)
        monkeypatch.setattr(blocks, "LONG", long)
        found = text.inverted_index(docs, size=size, ranges=ranges, whole=True)
        assert sorted(map(tuple, found.collect())) == want
    common = [r for r in want if r[0] == "the"]
    assert sum(len(r[4]) for r in common) == 151 and len(common) == (51 if size == 3 else 1)


def test_index_of_whole_documents_moves_no_row_per_posting(spark):
    docs = spark.createDataFrame([(f"d{i:03}", "a b c d e f g h") for i in range(500)], "doc STRING, text STRING")
    lists = ops.term_lists(blocks.with_range(docs, "doc", ["d250"]).repartition(blocks.RANGE))
    assert sorted((r.term, r.n, len(r["items"])) for r in lists.collect()) == sorted(
        (t, 250, 250) for t in "abcdefgh" for _ in range(2))


def test_index_of_no_documents(spark):
    docs = spark.createDataFrame([], "doc STRING, text STRING")
    assert text.inverted_index(docs, whole=True).collect() == []


def block(rng, n, first, d=16):
    return {"id": pa.array(np.arange(first, first + n)), "x": np.round(rng.normal(0, 0.4, (n, d)), 1),
            "label": pa.array(rng.integers(0, 3, n)), "p": rng.random(n), "z": rng.random(n)}


@pytest.mark.parametrize("diagonal", [True, False])
def test_a_cell_is_worked_out_in_strips(monkeypatch, diagonal):
    rng, a = np.random.default_rng(1), np.diag(np.linspace(0.5, 1.5, 16))
    own = block(rng, 300, 0)
    other = own if diagonal else block(rng, 210, 300)
    usual = samples._cell_sums(own, other, a, diagonal), samples._cell_fold(own, other, a, diagonal)
    k = np.exp(-samples._squares(own["x"], other["x"], a))
    if diagonal:
        np.fill_diagonal(k, 0.0)
    same = own["label"].to_numpy()[:, None] == other["label"].to_numpy()[None, :]
    assert np.allclose(usual[0][0], [k.sum(axis=1), (k * same).sum(axis=1)])
    assert np.allclose(usual[0][1], [k.sum(axis=0), (k * same).sum(axis=0)])
    v = k * (own["p"][:, None] - same) / own["z"][:, None]
    if not diagonal:
        v += k * (other["p"][None, :] - same) / other["z"][None, :]
    away = own["x"][:, None] - other["x"][None]
    assert np.allclose(usual[1], np.einsum("ij,ijr,ijc->rc", v, away, away))
    monkeypatch.setattr(samples, "STRIP", 7)
    assert np.allclose(usual[1], samples._cell_fold(own, other, a, diagonal))


def test_a_cell_of_large_blocks_takes_little_memory():
    rng = np.random.default_rng(2)
    own, other = block(rng, 2048, 0), block(rng, 2048, 2048)
    tracemalloc.start()
    samples._cell_sums(own, other, np.eye(16), False)
    samples._cell_fold(own, other, np.eye(16), False)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2048 * 2048 * 8 / 2


@pytest.mark.parametrize("diagonal, k", [(True, 4), (False, 4), (True, 500), (False, 1)])
def test_nearest_of_a_block_with_many_ties(diagonal, k):
    rng = np.random.default_rng(3)
    own = block(rng, 60, 0, 2)
    other = own if diagonal else block(rng, 45, 60, 2)
    order = rng.permutation(len(other["id"]))
    other = {name: v.take(pa.array(order)) if name in ("id", "label") else v[order] for name, v in other.items()}
    if diagonal:
        own = other
    d = np.round(np.sqrt(samples._squares(own["x"], other["x"], np.eye(2))), 1)
    found = samples._nearest_batch(own, other, d, k, diagonal).to_pylist()
    want, names = [], other["id"].to_pylist()
    for i, name in enumerate(own["id"].to_pylist()):
        near = sorted((d[i, j], names[j]) for j in range(len(names)) if not (diagonal and i == j))[:k]
        want += [(name, far, j) for far, j in near]
    assert sorted((r["id"], r["distance"], r["neighbour"]) for r in found) == sorted(want)


def test_a_task_sends_k_rows_for_a_sample_however_many_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, [float(v) for v in rng.normal(0, 1, 3)]) for i in range(200)]
    frame = spark.createDataFrame(rows, "id BIGINT, label INT, x ARRAY<DOUBLE>")
    sent = samples.nearest(frame, np.eye(3), 40, 2).count()
    groups = samples.group_count(40, 8)
    assert sent <= 200 * 2 * groups


def test_a_claim_is_made_by_one_thread_at_a_time(spark, tmp_path, monkeypatch):
    """A store that looks for the file and makes it in two steps, as a local folder does."""
    class Store:
        made, clashes = set(), []

        def exists(self, file):
            return False

        def create(self, file, overwrite):
            if file in self.made:
                raise RuntimeError("AlreadyExists")
            time.sleep(0.05)
            if file in self.made:
                self.clashes.append(file)
            self.made.add(file)
            return io.BytesIO()

    store = Store()
    monkeypatch.setattr(keyed_table, "_store", lambda spark, path: (store, path))

    def claim(_):
        try:
            return keyed_table._write_once(spark, "claim", {})
        except RuntimeError:
            return False

    with ThreadPoolExecutor(4) as pool:
        assert sorted(pool.map(claim, range(4))) == [False, False, False, True]
    assert store.clashes == []
