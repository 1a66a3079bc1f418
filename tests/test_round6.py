"""The check of round 3."""

import numpy as np

from quillmesh.llm import ngram_join, substrings


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(3)


def written(monkeypatch, module):
    """The tables that the module keeps, by name."""
    seen, keep = {}, module.keep
    monkeypatch.setattr(module, "keep", lambda rows, name: keep(seen.setdefault(name, rows), name))
    return seen


def test_what_is_left_is_cut_where_texts_are_read(spark, monkeypatch):
    """Before, whole texts went to Python and what was left of them came back, thousands in a batch."""
    seen = written(monkeypatch, substrings)
    twice = "é\x00ÿ€\U0001f600 ab" * 5
    texts = [f"0123{twice}4567", f"x{twice}", twice + "é", None, "", "short é"]
    got = substrings.without_repeats(documents(spark, texts), 60, 16)
    want, raw = [], [(t or "").encode() for t in texts]
    strings = [t[i:i + 60] for t in raw for i in range(len(t) - 59)]
    for at, t in enumerate(raw):
        gone = {i + k for i in range(len(t) - 59) if strings.count(t[i:i + 60]) > 1 for k in range(60)}
        want.append((at, len(t), len(gone), len(gone - {i + 1 for i in gone}),
                     bytes(x for i, x in enumerate(t) if i not in gone)))
    assert sorted((*r[:4], bytes(r.kept)) for r in got.collect()) == want and want[0][2] > 60
    assert "MapInArrow" not in got._jdf.queryExecution().toString()
    # Contexts to be sorted are broadcast in two numbers each; they were structs of five.
    assert seen["wanted"].dtypes == [("uid", "bigint"), ("places", "array<bigint>"), ("anchors", "array<bigint>")]


def test_anchors_of_many_texts_come_in_several_batches(spark):
    """Before, the contexts of a whole batch were put together."""
    texts = documents(spark, [f"{i} " * 200 for i in range(700)]).coalesce(1)
    rows = substrings.context_anchors(texts.withColumnRenamed("doc_id", "uid"), 400, 64)
    sizes = rows.mapInArrow(lambda batches: (b.slice(0, 1) for b in batches), rows.schema).count()
    assert sizes >= 700 // substrings._TEXTS


def test_trees_and_sketches_are_shuffled_once_at_most(spark, monkeypatch):
    """Before, rows of trees were dealt twice, and sketches were, to drop those of equal sets."""
    seen = written(monkeypatch, ngram_join)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = np.random.default_rng(5)
        texts = [" ".join(map(str, rng.integers(0, 900, 60))) for _ in range(60)]
        got = ngram_join.ngram_classes(documents(spark, texts + [t + " more" for t in texts[:20]] + texts[:5])).collect()
        plans = {name: rows._jdf.queryExecution().executedPlan().toString() for name, rows in seen.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r.component_id for r in sorted(got)] == [*range(60), *range(20), *range(5)]
    assert plans["members"].count("hashpartitioning(") == 1
    assert "hashpartitioning" not in plans["sets"]
