import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from quillmesh.sources import keyed_table

SCHEMA = "word STRING, avg_count DOUBLE"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def scanned(spark, path):
    return sorted(map(tuple, keyed_table.scan_rows(spark, path).collect()), key=str)


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_scan_of_versions_shuffles_nothing(spark, tmp_path, broadcast):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    want = {}
    for version in range(1, 5):
        rows = {f"w{i}": float(version * 100 + i) for i in range(version, 300, version)}
        assert keyed_table.put_rows(frame(spark, list(rows.items())), path, "word", buckets=6) == version
        want |= rows
    rows = keyed_table.scan_rows(spark, path)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan
    assert sorted(map(tuple, rows.collect())) == sorted(want.items())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    files = [f for f in os.listdir(f"{path}/version=2") if f.endswith(".parquet")]
    assert len(files) <= 6
    assert spark.catalog.listTables() == [] or not any(
        t.name.startswith(("put_", "scan_")) for t in spark.catalog.listTables())


def test_null_keys_and_null_values(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.put_rows(frame(spark, [(None, 1.0), ("a", 1.0), ("b", 2.0)]), path, "word")
    keyed_table.put_rows(frame(spark, [(None, 3.0), ("a", None)]), path, "word")
    want = [("a", None), ("b", 2.0), (None, 3.0)]
    assert scanned(spark, path) == sorted(want, key=str)
    keyed_table.compact(spark, path)
    assert scanned(spark, path) == sorted(want, key=str)


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.put_rows(frame(spark, [("a", 1.0), ("b", 1.0)]), path, "word", buckets=4)
    keyed_table.put_rows(frame(spark, [("b", 2.0), ("c", 2.0)]), path, "word")
    late = keyed_table._claim(spark, path)  # a writer that ends after the compaction
    keyed_table.put_rows(frame(spark, [("c", 4.0)]), path, "word")
    assert keyed_table.compact(spark, path) == 5
    assert keyed_table._live(spark, path) == [5]
    assert scanned(spark, path) == [("a", 1.0), ("b", 2.0), ("c", 4.0)]
    stamped = spark.createDataFrame([("b", 3.0, late), ("c", 3.0, late)], f"{SCHEMA}, _version BIGINT")
    keyed_table._write(stamped, path, late)
    # Later than the second put, earlier than the fourth.
    assert scanned(spark, path) == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    assert keyed_table.compact(spark, path) == 6
    assert keyed_table.drop_covered(spark, path) == [1, 2, 3, 4, 5]
    assert scanned(spark, path) == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    assert keyed_table.put_rows(frame(spark, [("d", 7.0)]), path, "word") == 7
    assert scanned(spark, path) == [("a", 1.0), ("b", 3.0), ("c", 4.0), ("d", 7.0)]


def test_unfinished_compaction_hides_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed_table.put_rows(frame(spark, [("a", 1.0)]), path, "word")
    version = keyed_table.compact(spark, path)
    os.rename(f"{path}/version={version}/_SUCCESS", f"{path}/version={version}/_failed")
    assert keyed_table._live(spark, path) == [1]
    assert scanned(spark, path) == [("a", 1.0)]


def test_writers_at_once_get_versions_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        claims = list(pool.map(lambda _: keyed_table._claim(spark, path), range(12)))
    assert sorted(claims) == list(range(1, 13))


def test_reserved_column_and_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "word STRING, _version INT")
    with pytest.raises(ValueError):
        keyed_table.put_rows(rows, str(tmp_path / "t"), "word")
    with pytest.raises(ValueError):
        keyed_table.scan_rows(spark, str(tmp_path / "u"))
