"""Findings of round 3."""

import random

import numpy as np
import pytest

from quillmesh.llm.ngram_join import Classes
from quillmesh.operators import graph as ops
from quillmesh.operators import text as text_ops
from quillmesh.plans import text
from test_graph import brute_force


@pytest.mark.parametrize("light, wedges, dealt", [(0, 1 << 22, 1 << 14), (4, 40, 3), (10, 40, 1), (1000, 7, 2)])
def test_triangles_of_light_and_heavy_vertices(spark, monkeypatch, light, wedges, dealt):
    monkeypatch.setattr(ops, "TASK_WEDGES", wedges)
    monkeypatch.setattr(ops, "DEALT", dealt)
    rng = random.Random(5)
    pairs = [(rng.randrange(40), rng.randrange(200)) for _ in range(900)] + [(300, i) for i in range(300)] + [(7, 7)]
    for kind, name in (("BIGINT", int), ("STRING", "v{}".format)):
        edges = spark.createDataFrame([(name(a), name(b)) for a, b in pairs], f"src {kind}, dst {kind}")
        for mode in ops.MODES:
            assert ops.count_triangles(edges, mode, light=light).first().n == brute_force(pairs, mode)[1]


def test_copies_of_a_light_graph_need_no_colours(spark, monkeypatch):
    """Before, an edge went to as many tasks as there were colours, which grew with the edges."""
    seen = []
    monkeypatch.setattr(ops, "colour_count", lambda edges: seen.append(edges) or 3)
    pairs = [(100 * copy + a, 100 * copy + b) for copy in range(20) for a in range(9) for b in range(a)]
    edges = spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")
    assert ops.count_triangles(edges).first().n == 20 * 84
    assert seen == [0]


def test_points_tell_near_copies_that_are_not_alike():
    """Before, too many of such pairs passed the bound, which grew with the square of a group of near copies."""
    classes, rng, passed = Classes(85), np.random.default_rng(3), 0
    for _ in range(200):
        codes = rng.integers(0, 1 << 63, 171, dtype=np.uint64)
        x, y = np.sort(codes[:146]), np.sort(np.concatenate([codes[:121], codes[146:]]))  # 121 of 171 shared
        (k, *_) = classes.of(146)
        points = classes.points([classes.point(x, k).tobytes(), classes.point(y, k).tobytes()], k)
        both = np.minimum(*points).sum(dtype=np.int64)
        assert both >= 121
        passed += both >= classes.shared(146, 146)
    assert passed < 10


def test_points_hold_counts_of_any_size():
    classes = Classes(85)
    sets = [np.arange(600, dtype=np.uint64), np.arange(550, dtype=np.uint64) << np.uint64(50)]
    (k, *_) = classes.of(600)
    points = classes.points([classes.point(x, k).tobytes() for x in sets], k)
    assert points.sum(axis=1).tolist() == [600, 550] and points.max() == 600
    assert classes.points([classes.point(sets[1], k).tobytes()], k).sum() == 550


@pytest.mark.parametrize("chunk", [1, 16 << 20])
def test_averages_are_counted_where_documents_lie(spark, monkeypatch, chunk):
    """Before, a row for each term of a document was aggregated and shuffled."""
    monkeypatch.setattr(text_ops, "CHUNK_BYTES", chunk)
    rows = [("a", "X x y"), ("b", "y\ty  z"), ("a", "x"), ("c", None), ("c", ""), ("d", " \u0130 \x0b"), (None, "y z"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc STRING, text STRING").repartition(5)
    found = text.term_averages(docs, whole=True)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, text.term_averages(docs).collect()))
    assert "explode" not in found._jdf.queryExecution().toString().lower()
