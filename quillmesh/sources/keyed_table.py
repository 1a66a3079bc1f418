"""A table with one live row per key, kept as Parquet.

Each put adds a version folder, cut into buckets by key and sorted in them; a
scan returns the newest row of every key. Versions have the same buckets, so
they are merged bucket by bucket: no row is shuffled. ``compact`` writes what a
scan returns as a version that stands for those it read, and says which they
are, so a put that ends late keeps its place among them.

A version number belongs to the writer that made its claim file, which only one
can; versions and compactions count once they are finished. A null key is a key.
"""

from __future__ import annotations

import json
import threading
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import write_key_values

_VERSION = "version"
_STAMP = "_version"  # the put that a row comes from
_TABLE = "_table.json"
_COVERS = "_covers.json"
BUCKETS = 64
# Local folders look for a file and make it in two steps.
_MAKING = threading.Lock()


def put_rows(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> int:
    """Insert or overwrite by key. Returns the version written.

    Of two rows with one key in a single put, the greater is kept. ``buckets`` is
    that of the first put.
    """
    if _STAMP in rows.columns:
        raise ValueError(f"a column must not be named {_STAMP}")
    spark = rows.sparkSession
    _write_once(spark, f"{path}/{_TABLE}", {"key": key, "buckets": buckets})
    version = _claim(spark, path)
    values = [c for c in rows.columns if c != key]
    if len(values) == 1:
        single = rows.groupBy(key).agg(F.max(values[0]).alias(values[0]))
    else:
        greatest = F.max(F.struct(*values)).alias("row")
        single = rows.groupBy(key).agg(greatest).select(key, "row.*")
    _write(single.withColumn(_STAMP, F.lit(version).cast("bigint")), path, version)
    return version


def scan_rows(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every key; only puts that were finished count."""
    return _merged(spark, path, _live(spark, path)).drop(_STAMP)


def compact(spark: SparkSession, path: str) -> int:
    """Write the newest row of every key as one version. Returns it.

    Earlier versions are not read from then on; ``drop_covered`` deletes them.
    """
    live = _live(spark, path)
    version = _claim(spark, path)
    covered = sorted({*live, *(v for each in live for v in _covers(spark, path, each))})
    _write_once(spark, f"{path}/{_VERSION}={version}-covers/{_COVERS}", covered)
    _write(_merged(spark, path, live), path, version)
    return version


def drop_covered(spark: SparkSession, path: str) -> list:
    """Delete the versions that a compaction stands for. Returns them.

    Not for as long as a scan that began before the compaction still runs.
    """
    store, top = _store(spark, path)
    live = _live(spark, path)
    covered = {v for each in live for v in _covers(spark, path, each)}
    gone = [version for version in _versions(spark, path) if version in covered]
    for version in gone:
        store.delete(_path(spark, f"{path}/{_VERSION}={version}"), True)
    return gone


def export_rows(spark: SparkSession, path: str, out: str, mode: str = "errorifexists") -> None:
    """``key<tab>value`` text files of a two-column table."""
    rows = scan_rows(spark, path)
    key, value = rows.columns
    write_key_values(rows, out, F.col(key), F.col(value), mode)


def _merged(spark: SparkSession, path: str, versions: list) -> DataFrame:
    """The newest row of every key, with the version that it was put in."""
    if not versions:
        raise ValueError(f"there is no finished version in {path}")
    key = json.loads(_text(spark, f"{path}/{_TABLE}"))["key"]
    stored = {version: _read(spark, path, version) for version in versions}
    if len(versions) == 1:
        return stored[versions[0]]
    # Puts whose rows a version holds: the least and the greatest.
    puts = {version: _covers(spark, path, version) or [version] for version in versions}
    live = []
    for version, own in stored.items():
        own = own.where(F.col(key).isNotNull())
        for other in versions:
            if other != version and max(puts[other]) > min(puts[version]):
                later = stored[other].select(F.col(key).alias("_key"), F.col(_STAMP).alias("_later"))
                own = own.join(later, (F.col(key) == F.col("_key")) & (F.col("_later") > F.col(_STAMP)), "left_anti")
        live.append(own)
    # The null key, which no join meets: a row to a version.
    columns = stored[versions[-1]].columns
    null = reduce(DataFrame.unionByName, [rows.where(F.col(key).isNull()) for rows in stored.values()])
    newest = null.agg(F.max_by(F.struct(*columns), _STAMP).alias("_row")).where("_row IS NOT NULL")
    return reduce(DataFrame.unionByName, [*live, newest.select("_row.*")])


def _write(rows: DataFrame, path: str, version: int) -> None:
    """Bucketed files in a folder of their own; the catalog is left as it was."""
    spark = rows.sparkSession
    table = json.loads(_text(spark, f"{path}/{_TABLE}"))
    name = f"put_{uuid.uuid4().hex}"
    # The order of tasks is that of the buckets, so each bucket is one file.
    dealt = rows.repartition(table["buckets"], table["key"])
    try:
        (dealt.write.format("parquet").mode("errorifexists").bucketBy(table["buckets"], table["key"])
         .sortBy(table["key"]).option("path", f"{path}/{_VERSION}={version}").saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _read(spark: SparkSession, path: str, version: int) -> DataFrame:
    """A version as a bucketed table, which is registered only to be looked up."""
    table = json.loads(_text(spark, f"{path}/{_TABLE}"))
    folder = f"{path}/{_VERSION}={version}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema)
    name = f"scan_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{table['key']}`) "
        f"SORTED BY (`{table['key']}`) INTO {table['buckets']} BUCKETS LOCATION '{folder}'")
    try:
        return spark.table(name).select("*")
    finally:
        spark.sql(f"DROP TABLE {name}")


def _live(spark: SparkSession, path: str) -> list:
    """Finished versions that no finished compaction stands for."""
    versions = _versions(spark, path)
    covered = {v for version in versions for v in _covers(spark, path, version)}
    return [version for version in versions if version not in covered]


def _covers(spark: SparkSession, path: str, version: int) -> list:
    text = _text(spark, f"{path}/{_VERSION}={version}-covers/{_COVERS}")
    return json.loads(text) if text else []


def _claim(spark: SparkSession, path: str) -> int:
    """A version number that no other writer gets."""
    version = max(_versions(spark, path, finished=False), default=0) + 1
    while not _write_once(spark, f"{path}/_claims/{version}", {}):
        version += 1
    return version


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str) -> tuple:
    top = _path(spark, path)
    return top.getFileSystem(spark._jsc.hadoopConfiguration()), top


def _write_once(spark: SparkSession, path: str, content) -> bool:
    """Whether the file was not there yet; a store makes a file for one writer only.

    A local folder does so for the threads of one driver.
    """
    store, file = _store(spark, path)
    if store.exists(file):
        return False
    try:
        with _MAKING:
            stream = store.create(file, False)
    except Py4JJavaError as failed:
        if "AlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    return True


def _text(spark: SparkSession, path: str) -> str:
    """The content of a small file; empty if there is none."""
    store, file = _store(spark, path)
    if not store.exists(file):
        return ""
    stream = store.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _versions(spark: SparkSession, path: str, finished: bool = True) -> list:
    """Numbers of the version folders, by listing them."""
    store, top = _store(spark, path)
    if not store.exists(top):
        return []
    found = []
    for status in store.listStatus(top):
        folder = status.getPath()
        number = folder.getName().removeprefix(f"{_VERSION}=")
        done = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        if number.isdigit() and (not finished or store.exists(done)):
            found.append(int(number))
    return sorted(found)
