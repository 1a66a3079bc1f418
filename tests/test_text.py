import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmesh.functions.text import author_of, leading_number, render_postings
from quillmesh.operators import skew
from quillmesh.operators import text as ops
from quillmesh.operators.blocks import item_splits, list_blocks
from quillmesh.plans import text

NOVELS = [
    ("authora1", "Sword moon sword"),
    ("authora2", "moon"),
    ("authorb1", "sword river"),
    ("authorb1", ""),
]


@pytest.fixture(scope="module")
def novels(spark):
    return spark.createDataFrame(NOVELS, "doc STRING, text STRING")


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame([("authora1",), ("authora2",), ("authorb1",)], "doc STRING")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_word_count_keeps_case(novels):
    assert rows(text.word_count(novels)) == [("Sword", 1), ("moon", 2), ("river", 1), ("sword", 2)]


def test_only_ascii_blanks_separate(spark):
    docs = spark.createDataFrame([("d1", " a\tb\r\nc\fd e　f\x0bg ")], "doc STRING, text STRING")
    assert rows(text.word_count(docs)) == [("a", 1), ("b", 1), ("c", 1), ("d e　f\x0bg", 1)]


def test_inverted_index(novels):
    index = text.inverted_index(novels)
    lines = rows(text.index_lines(index))
    assert lines == [
        ("moon", "1.0, authora1: 1; authora2: 1; "),
        ("river", "1.0, authorb1: 1; "),
        ("sword", "1.5, authora1: 2; authorb1: 1; "),
    ]
    assert rows(index.select("term", "block", "n_docs")) == [
        ("moon", 0, 2), ("river", 0, 1), ("sword", 0, 2)
    ]


def test_index_by_frequency_order(novels):
    index = text.index_by_frequency(text.inverted_index(novels))
    got = [(r.term, r.avg_count) for r in index.collect()]
    assert got == [("moon", 1.0), ("river", 1.0), ("sword", 1.5)]


def test_sorting_raw_lines(spark):
    lines = ["b\t10.5, x: 21; y: 0; ", "a\t9.0, x: 9; ", "c\t100.0, x: 100; "]
    df = spark.createDataFrame([(v,) for v in lines], "value STRING")
    assert [r.value for r in text.sort_index_lines(df).collect()] == [lines[1], lines[0], lines[2]]


def test_bad_leading_number_raises(spark):
    df = spark.createDataFrame([("a\tnone, x: 1; ",)], "value STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(leading_number(F.col("value"))).collect()


def test_thresholds_are_strict_and_top_breaks_ties_by_term(novels):
    averages = text.term_averages(novels).select("term", "avg_count")
    assert rows(ops.above_average(averages, 1.0)) == [("sword", 1.5)]
    assert rows(ops.above_average(averages, 1.5)) == []
    assert [r.term for r in ops.top_averages(averages, 2).collect()] == ["sword", "moon"]


def test_author_documents(listed):
    assert rows(ops.author_documents(listed)) == [("authora", 2), ("authorb", 1)]


def test_author_stops_at_first_digit(spark):
    df = spark.createDataFrame([("ab12cd3",), ("7x",), ("none",)], "doc STRING")
    assert [r[0] for r in df.select(author_of(F.col("doc"))).collect()] == ["ab", "", "none"]


def test_tf_idf(novels, listed):
    got = {(r.author, r.term): (r.tf, r.df, r.tf_idf) for r in text.tf_idf(novels, listed).collect()}
    expected = {
        ("authora", "moon"): (2, 2, 2 * math.log(2 / 3)),
        ("authora", "sword"): (2, 1, 0.0),
        ("authorb", "river"): (1, 1, math.log(1 / 2)),
        ("authorb", "sword"): (1, 1, math.log(1 / 2)),
    }
    assert got.keys() == expected.keys()
    for key, (tf, df, weight) in expected.items():
        assert got[key] == (tf, df, pytest.approx(weight, abs=1e-12))


def test_tf_idf_drops_authors_not_listed(novels, spark):
    some = spark.createDataFrame([("authora1",), ("authora2",)], "doc STRING")
    assert {r.author for r in text.tf_idf(novels, some).collect()} == {"authora"}


def test_tf_idf_with_many_authors(novels, listed, monkeypatch):
    usual = rows(text.tf_idf(novels, listed))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    assert rows(text.tf_idf(novels, listed)) == usual


def test_broadcast_checks_rows_and_bytes(spark, monkeypatch):
    df = spark.createDataFrame([("ab", [1.0] * 4), (None, None)], "s STRING, x ARRAY<DOUBLE>")
    assert skew.is_small(df)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 33)
    assert not skew.is_small(df)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 34)
    assert skew.is_small(df)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 1)
    assert not skew.is_small(df)


def test_tf_idf_off_the_text_index(novels, listed):
    lines = text.index_lines(text.inverted_index(novels))
    assert rows(text.tf_idf_from_lines(lines, listed)) == rows(text.tf_idf(novels, listed))


def test_separators_inside_terms_and_names(spark):
    docs = spark.createDataFrame(
        [("c1", "a#b : ; ,"), ("d: e; f, 2", "a#b x:y")], "doc STRING, text STRING"
    )
    assert {r.term for r in text.term_counts(docs).collect()} == {"a#b", ":", ";", ",", "x:y"}
    one = docs.where("doc = 'c1'")
    back = ops.parse_index(text.index_lines(text.inverted_index(one)))
    assert rows(back) == rows(text.term_counts(one))
    named = docs.replace("d: e; f, 2", "d: e2")
    back = ops.parse_index(text.index_lines(text.inverted_index(named)))
    assert rows(back) == rows(text.term_counts(named))


def test_empty_input(spark):
    none = spark.createDataFrame([], "doc STRING, text STRING")
    assert rows(text.word_count(none)) == []
    assert rows(text.inverted_index(none)) == []
    assert rows(text.tf_idf(none, none.select("doc"))) == []


def test_common_terms_are_cut_into_whole_ordered_blocks(spark):
    docs = spark.range(1000).select(
        F.concat(F.lit("doc"), F.col("id").cast("string")).alias("doc"),
        F.concat(F.lit("the "), F.when(F.col("id") % 3 == 0, "fox the").otherwise("")).alias("text"),
    )
    index = text.inverted_index(docs, size=64, ranges=16)
    parts = index.where("term = 'the'").orderBy("block").collect()
    assert [r.block for r in parts] == list(range(16))
    assert [len(r.postings) for r in parts] == [64] * 15 + [40]
    found = [p.doc for r in parts for p in r.postings]
    assert found == sorted(f"doc{i}" for i in range(1000))
    assert {(r.avg_count, r.n_docs) for r in parts} == {(1.334, 1000)}
    assert sum(p.n for r in parts for p in r.postings) == 1334


def test_only_long_lists_are_ranked(spark):
    """Lists of 0 to 60 items, blocks of 20: short keys are collected, long ones cut, and both are whole."""
    pairs = spark.range(61).selectExpr("id AS k", "explode(sequence(1, int(id))) AS v").where("k > 0")
    for size in (20, 60, 1000):
        asked = []
        blocks = list_blocks(pairs, "k", "v", lambda: asked.append(1) or [5, 30], total="v", size=size).collect()
        assert len(asked) == (size < 60)
        for k in range(1, 61):
            own = sorted((b for b in blocks if b.k == k), key=lambda b: b.block)
            assert [b.block for b in own] == list(range(-(-k // size)))
            assert [i.v for b in own for i in b["items"]] == list(range(1, k + 1))
            assert all(b.n_items == k and b.total == k * (k + 1) // 2 and len(b["items"]) <= size for b in own)


def test_ranges_never_change_the_blocks(spark):
    pairs = spark.range(500).selectExpr("id % 3 AS k", "id AS v")
    for splits in ([], [7], [0, 100, 101, 400], item_splits(pairs.select("v"), 8)):
        got = list_blocks(pairs, "k", "v", lambda splits=splits: splits, size=50)
        for row in got.collect():
            want = [v for v in range(500) if v % 3 == row.k][row.block * 50:(row.block + 1) * 50]
            assert [p.v for p in row["items"]] == want


WORD = st.text(alphabet="aB:;,#é　", min_size=1, max_size=3)
TEXTS = st.lists(st.tuples(st.sampled_from(["x1", "x2", "y3"]), st.lists(WORD, max_size=6)), max_size=6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_index_holds_every_token_and_reads_back(spark, drawn):
    docs = spark.createDataFrame(
        [(doc, " ".join(words)) for doc, words in drawn], "doc STRING, text STRING"
    )
    counts = text.term_counts(docs)
    total = sum(len(words) for _, words in drawn)
    assert sum(r.n for r in counts.collect()) == total
    index = text.inverted_index(docs, size=2)
    assert rows(ops.parse_index(text.index_lines(index))) == rows(counts)
    assert index.select(render_postings(F.col("postings"))).count() == index.count()
