import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.llm import va_search

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, score STRING, rank INT"


def brute(rows, k):
    good = [(i, np.floor(64 * np.array(v, dtype=float))) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in good:
        if q % 20:
            continue
        scores = sorted((-int(x @ y), i) for i, y in good if i != q and len(y) == len(x))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(512, 8192, 64), (2, 7, 64), (4, 20, 2), (512, 8192, 1)])
def test_against_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(size=(150, 8)), 1).astype(np.float32).tolist()
    rows = list(enumerate(vectors))
    rows += [(200, None), (201, []), (202, [None] * 8), (203, [float("nan")] * 8), (None, vectors[0]),
             (204, [float("inf")] * 8), (220, [1.0, 2.0]), (221, [2.0, 1.0]), (7, vectors[3]), (240, [0.0] * 8)]
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = va_search.top_k(docs, F.col("vec_id") % 20 == 0, 5, query_block=blocks[0], vector_block=blocks[1],
                          cells=blocks[2])
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert va_search.top_k(docs, F.col("vec_id") % 20 == 0).count() == 0


def test_long_components_and_repeated_rows(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(60, 4)) * 1e6).astype(np.float32).tolist()
    rows = list(enumerate(vectors)) + [(i, vectors[3]) for i in (3, 3, 21, 22)]
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = va_search.top_k(docs, F.col("vec_id") % 20 == 0, 5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


@pytest.mark.parametrize("cells, share", [(16, 0.5), (64, 0.05)])
def test_few_exact_vectors_are_read(spark, tables, monkeypatch, cells, share):
    read = []
    exact = va_search.exact_scores

    def counted(pairs, vectors):
        read.append(pairs.count())
        return exact(pairs, vectors)

    monkeypatch.setattr(va_search, "exact_scores", counted)
    rows = tables("embeddings")
    n, asked = rows.count(), rows.where("vec_id % 20 = 0").count()
    assert va_search.top_k(rows, F.col("vec_id") % 20 == 0, cells=cells).count() == 20 * asked
    assert 20 * asked <= sum(read) < share * n * asked or sum(read) == 20 * asked
