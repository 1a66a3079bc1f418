import pytest
from pyspark.sql import functions as F

from quillmesh.__main__ import main
from quillmesh.operators import text as text_ops
from quillmesh.plans import text
from quillmesh.sources import delimited, keyed_table, matrices
from quillmesh.sources import text as files


@pytest.fixture(scope="module")
def novels(tmp_path_factory):
    folder = tmp_path_factory.mktemp("novels")
    for name, content in {
        "authora1.txt.segmented": "Sword moon\nsword\n",
        "authora2.txt.segmented": "moon\n",
        "authorb1.txt.segmented": "sword river\n\n",
        "金庸 +%x03.txt.segmented": "刀 剑 刀\n",
    }.items():
        (folder / name).write_text(content, encoding="utf-8")
    return str(folder)


def lines_of(path):
    return sorted(
        line for part in path.glob("part-*") for line in part.read_text("utf-8").splitlines()
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_documents_are_named_after_files(spark, novels):
    docs = files.read_documents(spark, novels)
    assert docs.count() == 6
    names = {"authora1", "authora2", "authorb1", "金庸 +%x03"}
    assert {r.doc for r in docs.collect()} == names
    assert {r.doc for r in files.read_document_names(spark, novels).collect()} == names


def test_key_values_cut_at_the_first_tab(spark, tmp_path):
    (tmp_path / "in").write_text("a\tb\tc\nalone\n\tv\n")
    assert rows(files.read_key_values(spark, str(tmp_path / "in"))) == [
        ("", "v"), ("a", "b\tc"), ("alone", "")
    ]


def test_edges_labels_pairs_and_lists(spark, tmp_path):
    (tmp_path / "edges").write_text('1 2\n"x" y\n')
    (tmp_path / "labels").write_text("0\t1\n1\tred\n")
    (tmp_path / "pairs").write_text("0,1\t0.5 -1e3\n")
    (tmp_path / "list").write_text("a1\na2\n")
    assert rows(files.read_edges(spark, str(tmp_path / "edges"))) == [('"x"', "y"), ("1", "2")]
    assert rows(files.read_labels(spark, str(tmp_path / "labels"))) == [("0", "1"), ("1", "red")]
    assert rows(files.read_pairs(spark, str(tmp_path / "pairs"))) == [("0", "1", [0.5, -1000.0])]
    assert rows(files.read_document_list(spark, str(tmp_path / "list"))) == [("a1",), ("a2",)]


def test_malformed_lines_raise(spark, tmp_path):
    (tmp_path / "edges").write_text("1\n")
    (tmp_path / "pairs").write_text("0,1\tx\n")
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        files.read_edges(spark, str(tmp_path / "edges")).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_pairs(spark, str(tmp_path / "pairs")).collect()


def test_text_sinks_quote_nothing(spark, tmp_path):
    df = spark.createDataFrame([('"q", \\', 2.0), ("plain", 1.5)], "k STRING, v DOUBLE")
    files.write_key_values(df, str(tmp_path / "kv"), F.col("k"), F.col("v"))
    assert lines_of(tmp_path / "kv") == ['"q", \\\t2.0', "plain\t1.5"]
    files.write_values(df, str(tmp_path / "v"), F.col("v"))
    assert lines_of(tmp_path / "v") == ["1.5", "2.0"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_values(df, str(tmp_path / "v"), F.col("v"))


def test_keyed_table_keeps_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "word STRING, avg_count DOUBLE"
    assert keyed_table.put_rows(spark.createDataFrame([("a", 9.0), ("b", 2.0)], schema), path, "word") == 1
    assert keyed_table.put_rows(spark.createDataFrame([("a", 1.0), ("c", 3.0)], schema), path, "word") == 2
    assert rows(keyed_table.scan_rows(spark, path)) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]
    keyed_table.export_rows(spark, path, str(tmp_path / "tsv"))
    assert lines_of(tmp_path / "tsv") == ["a\t1.0", "b\t2.0", "c\t3.0"]


def test_averages_from_store_to_sql(spark, novels, tmp_path):
    docs = files.read_documents(spark, novels)
    path = str(tmp_path / "averages")
    text.store_averages(docs, path)
    keyed_table.export_rows(spark, path, str(tmp_path / "tsv"))
    delimited.create_delimited_table(spark, "averages", "word STRING, count DOUBLE")
    delimited.load_delimited(spark, "averages", str(tmp_path / "tsv"))
    assert rows(spark.sql("SELECT * FROM averages WHERE count > 1.0")) == [("sword", 1.5), ("刀", 2.0)]
    top = spark.sql("SELECT * FROM averages ORDER BY count DESC, word LIMIT 2")
    assert [r.word for r in top.collect()] == ["刀", "sword"]
    delimited.load_delimited(spark, "averages", str(tmp_path / "tsv"))
    assert spark.table("averages").count() == 10


def test_delimited_table_takes_any_term(spark, tmp_path):
    terms = ['"', 'a"b', '"q"', "\\", "a\\b", "#x", "'", "x,y", " lead", "né", "刀"]
    (tmp_path / "tsv").write_text("".join(f"{t}\t{n}.5\n" for n, t in enumerate(terms)), "utf-8")
    delimited.create_delimited_table(spark, "odd_terms", "word STRING, count DOUBLE")
    delimited.load_delimited(spark, "odd_terms", str(tmp_path / "tsv"))
    assert rows(spark.table("odd_terms")) == sorted((t, n + 0.5) for n, t in enumerate(terms))


def test_keyed_matrices_and_models(spark, tmp_path):
    pairs = spark.createDataFrame([("0", "1", [1.0, 2.0])], "i STRING, j STRING, x ARRAY<DOUBLE>")
    matrices.write_keyed(pairs, str(tmp_path / "pairs"))
    assert rows(matrices.read_keyed(spark, str(tmp_path / "pairs"))) == rows(pairs)
    history = [[[1.0, 0.0], [0.0, 1.0]], [[1.5, 2.0], [3.0, 4.0]]]
    matrices.save_model(spark, history, str(tmp_path / "model"))
    assert matrices.load_model(spark, str(tmp_path / "model")).tolist() == history[1]
    assert matrices.load_model(spark, str(tmp_path / "model"), 0).tolist() == history[0]


def test_text_jobs_from_the_command_line(spark, novels, tmp_path):
    out = {name: tmp_path / name for name in
           ("words", "index", "sorted", "weights", "bare", "table", "tsv", "above", "top")}
    main(["word-count", novels, str(out["words"])])
    assert lines_of(out["words"]) == sorted(
        ["Sword\t1", "moon\t2", "sword\t2", "river\t1", "刀\t2", "剑\t1"])
    main(["inverted-index", novels, str(out["index"])])
    index = {
        "moon\t1.0, authora1: 1; authora2: 1; ", "river\t1.0, authorb1: 1; ",
        "sword\t1.5, authora1: 2; authorb1: 1; ", "刀\t2.0, 金庸 +%x03: 2; ", "剑\t1.0, 金庸 +%x03: 1; ",
    }
    assert set(lines_of(out["index"])) == index
    main(["count-sort", str(out["index"]), str(out["sorted"])])
    in_order = [r.value for r in spark.read.text(str(out["sorted"])).collect()]
    assert set(in_order) == index and in_order[-1].startswith("刀") and in_order[-2].startswith("sword")
    (tmp_path / "list").write_text("authora1\nauthora2\nauthorb1\n")
    main(["tf-idf", str(tmp_path / "list"), str(out["index"]), str(out["weights"])])
    weights = dict(line.split("\t") for line in lines_of(out["weights"]))
    assert set(weights) == {"authora, moon", "authora, sword", "authorb, river", "authorb, sword"}
    assert float(weights["authora, moon"]) == pytest.approx(-0.810930, abs=1e-6)
    main(["store-index", novels, str(out["table"]), str(out["bare"])])
    assert "sword\tauthora1: 2; authorb1: 1; " in lines_of(out["bare"])
    main(["export-averages", str(out["table"]), str(out["tsv"])])
    assert lines_of(out["tsv"]) == sorted(["moon\t1.0", "river\t1.0", "sword\t1.5", "刀\t2.0", "剑\t1.0"])
    main(["frequent-words", str(out["tsv"]), str(out["above"]), "--threshold", "1.5"])
    assert lines_of(out["above"]) == ["刀\t2.0"]
    main(["top-words", str(out["tsv"]), str(out["top"]), "--k", "2"])
    assert lines_of(out["top"]) == ["sword\t1.5", "刀\t2.0"]


def test_graph_and_metric_jobs_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "edges").write_text("1 2\n2 1\n2 3\n3 2\n1 3\n3 4\n4 4\n")
    main(["adjacency", str(tmp_path / "edges"), str(tmp_path / "adj"), "undirected"])
    assert lines_of(tmp_path / "adj") == ["1\t2 3", "2\t1 3", "3\t1 2 4", "4\t3"]
    main(["triangle-count", str(tmp_path / "adj"), str(tmp_path / "n")])
    assert lines_of(tmp_path / "n") == ["1"]
    main(["triangles", str(tmp_path / "edges"), str(tmp_path / "m"), "directed"])
    assert lines_of(tmp_path / "m") == ["0"]
    (tmp_path / "pairs").write_text(
        "".join(f"{i},{j}\t{float(i - j)}\n" for i in range(3) for j in range(3)))
    (tmp_path / "labels").write_text("0\t0\n1\t0\n2\t1\n")
    main(["nca", str(tmp_path / "pairs"), str(tmp_path / "labels"), str(tmp_path / "model"),
          "1", "0.1", "1"])
    assert matrices.load_model(spark, str(tmp_path / "model"))[0, 0] == pytest.approx(1.013553, abs=1e-6)
    assert capsys.readouterr().out.startswith("1.01355")
    learned = [str(tmp_path / "model"), "--epoch", "0"]
    main(["pair-probabilities", str(tmp_path / "pairs"), learned[0], str(tmp_path / "p"), *learned[1:]])
    p = dict(line.split("\t") for line in lines_of(tmp_path / "p"))
    assert float(p["0,1"]) == pytest.approx(0.952574, abs=1e-6) and float(p["1,1"]) == 0.0
    main(["pair-success", str(tmp_path / "pairs"), str(tmp_path / "labels"), learned[0],
          str(tmp_path / "success"), *learned[1:]])
    success = dict(line.split("\t") for line in lines_of(tmp_path / "success"))
    assert float(success["1"]) == pytest.approx(0.5) and float(success["2"]) == 0.0
