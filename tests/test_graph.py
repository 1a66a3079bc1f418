import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.operators import graph as ops
from quillmesh.operators.skew import hot_keys
from quillmesh.plans import graph

FIRST = "1-2 2-1 2-3 3-2 1-3 3-4 4-4"
SECOND = "1-2 2-1 2-3 3-2 1-3 3-1 3-4 1-2"


def edges_of(spark, text, kind="STRING"):
    ends = [tuple(e.split("-")) for e in text.split()]
    return spark.createDataFrame(ends, "src STRING, dst STRING").select(
        F.col("src").cast(kind), F.col("dst").cast(kind)
    )


def triangles(edges, mode):
    return graph.triangle_count(edges, mode).first().n


def brute_force(pairs, mode):
    directed = {(a, b) for a, b in pairs if a != b}
    lines = {frozenset(e) for e in directed}
    if mode == "directed":
        lines = {frozenset(e) for e in directed if e[::-1] in directed}
    near = {}
    for a, b in map(tuple, lines):
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return len(lines), sum(len(near[a] & near[b]) for a, b in map(tuple, lines)) // 3


@pytest.mark.parametrize("kind", ["STRING", "BIGINT"])
@pytest.mark.parametrize(
    "text, mode, n_edges, n_triangles",
    [
        (FIRST, "undirected", 4, 1),
        (FIRST, "directed", 2, 0),
        (SECOND, "undirected", 4, 1),
        (SECOND, "directed", 3, 1),
    ],
)
def test_edges_and_triangles(spark, kind, text, mode, n_edges, n_triangles):
    edges = edges_of(spark, text, kind)
    assert ops.simple_edges(edges, mode).count() == n_edges
    assert triangles(edges, mode) == n_triangles


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("undirected", {"1": ["2", "3"], "2": ["1", "3"], "3": ["1", "2", "4"], "4": ["3"]}),
        ("directed", {"1": ["2"], "2": ["1", "3"], "3": ["2"]}),
    ],
)
def test_adjacency(spark, mode, expected):
    lists = graph.adjacency(edges_of(spark, FIRST), mode).collect()
    assert {r.vertex: r.neighbours for r in lists} == expected
    assert all(r.degree == len(r.neighbours) and r.block == 0 for r in lists)


def test_adjacency_text_reads_back(spark):
    lists = graph.adjacency(edges_of(spark, FIRST))
    lines = graph.adjacency_lines(lists)
    assert {(r.key, r.value) for r in lines.collect()} == {
        ("1", "2 3"), ("2", "1 3"), ("3", "1 2 4"), ("4", "3")
    }
    assert triangles(graph.edges_of(lists), "undirected") == 1


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        graph.triangle_count(edges_of(spark, FIRST), "sideways")


def test_no_edges(spark):
    empty = spark.createDataFrame([], "src STRING, dst STRING")
    for mode in ops.MODES:
        assert triangles(empty, mode) == 0
        assert graph.adjacency(empty, mode).count() == 0
    assert triangles(edges_of(spark, "1-1 2-2"), "undirected") == 0


def test_random_graph_against_brute_force(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(500)]
    edges = spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")
    for mode in ops.MODES:
        n_edges, n_triangles = brute_force(pairs, mode)
        assert ops.simple_edges(edges, mode).count() == n_edges
        assert triangles(edges, mode) == n_triangles
    any_way = triangles(edges, "undirected")
    assert triangles(edges.selectExpr("dst AS src", "src AS dst"), "undirected") == any_way
    assert triangles(edges.union(edges), "undirected") == any_way
    renamed = edges.selectExpr("concat('v', 97 * src % 41) AS src", "concat('v', 97 * dst % 41) AS dst")
    assert triangles(renamed, "undirected") == any_way
    assert triangles(edges, "directed") <= any_way


def test_hubs_with_a_third_of_all_edges(spark):
    """Two hubs tied to every vertex of a ring: hot keys take the salted way."""
    n = 3000
    pairs = [(v, (v + 1) % n) for v in range(n)]
    pairs += [(hub, v) for hub in (n, n + 1) for v in range(n)] + [(n, n + 1)]
    edges = spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")
    degree = ops.degrees(ops.simple_edges(edges))
    assert {r.vertex for r in hot_keys(degree, "vertex", "degree").collect()} == {n, n + 1}
    assert triangles(edges, "undirected") == brute_force(pairs, "undirected")[1]
    lists = graph.adjacency(edges, size=500).where(F.col("vertex") == n).orderBy("block").collect()
    assert [v for r in lists for v in r.neighbours] == list(range(n)) + [n + 1]
    assert max(len(r.neighbours) for r in lists) == 500


@pytest.mark.parametrize("colours", [None, 1, 2, 3, 9])
def test_tasks_of_colours_meet_each_triangle_once(spark, colours):
    pairs = [(0, i) for i in range(1, 30)] + [(i, j) for i in range(1, 30) for j in range(i + 1, 30, 3)]
    pairs += [(j, i) for i, j in pairs[::5]] + [(7, 7)]
    for mode in ("undirected", "directed"):
        edges = spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")
        assert ops.count_triangles(edges, mode, colours).first().n == brute_force(pairs, mode)[1]
    names = spark.createDataFrame([(f"v{a}", f"v{b}") for a, b in pairs], "src STRING, dst STRING")
    assert ops.count_triangles(names, "undirected", colours).first().n == brute_force(pairs, "undirected")[1]


@pytest.mark.parametrize("wedges", [1, 7, 1 << 20])
def test_triangles_of_a_task(monkeypatch, wedges):
    monkeypatch.setattr(ops, "WEDGES", wedges)
    rng = np.random.default_rng(8)
    pairs = sorted({tuple(sorted(p)) for p in rng.integers(0, 40, (300, 2)).tolist() if p[0] != p[1]})
    a, b = np.array(pairs).T
    weights = rng.integers(0, 2, 40)
    known = set(pairs)
    for total in range(4):
        want = sum((x, z) in known and (y, z) in known and weights[[x, y, z]].sum() == total
                   for x, y in pairs for z in range(y + 1, 40))
        assert ops.triangles(a, b, weights, total) == want


def test_colours_grow_with_the_root_of_the_edges():
    assert ops.colour_count(0) == ops.colour_count(10 ** 6) == ops.MIN_COLOURS
    assert 6 * 10 ** 12 / ops.colour_count(10 ** 12) ** 2 <= ops.TASK_EDGES
