"""Near duplicates by SimHash fingerprints, compared tile by tile.

Two fingerprints within the radius differ by no more than it in their
population counts, also when the counts of four quarters are added up. Distinct
fingerprints are grouped by such counts, so that only near groups meet, and
packed, in the order of their count, into tiles of bounded size. Tiles whose
counts are beyond the radius are skipped; the others are compared by
exclusive-or and bit counts, every fingerprint with every one.

Where a similarity is asked for, near copies are not told by fingerprints alone.
Fingerprints of the distinct shingles, under a wide radius, only find pairs; the
Jaccard index of the two sets of shingles decides. So that a large group of copies does not
meet pair by pair, texts are first verified against the least one they share a
least hash with, and pairs that those links connect already are left out.

Defined cases: a null or blank text has no words and fingerprint zero, linked
like any other; fewer words than a shingle make one shingle; equal texts share
a fingerprint; repeated rows come out as often as they come; an empty table
gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep
from .common import before
from .components import components, spanning_links

SHINGLE = 3
RADIUS = 2
SEED = 42
TILE = 2048
# For a similarity of 0.8 over five words: sets with that Jaccard index have a
# cosine of 0.89 and differ in 38 of 256 bits, 6 more or less; unrelated ones in 128.
# The radius finds candidates, the similarity is verified.
NEAR = {"shingle": 5, "words": 4, "radius": 60, "similarity": 0.8}
_BUCKETS = 64
_ROWS = 255  # whose bits add up in a byte


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, words: int = 1, radius: int = RADIUS,
                 seed: int = SEED) -> DataFrame:
    """(doc_id, fp, ones, group): a bit is set if it is in over half of the hashes.

    fp holds 64 bits per word, greatest first. ones is the population count and
    group what counts near ones under ``radius`` are found by.
    """
    schema = docs.select("doc_id", F.lit(b"").alias("fp"), F.lit(0).alias("ones"),
                         F.lit(0).alias("group")).schema

    def hashed(batches):
        for batch in batches:
            found = np.empty((batch.num_rows, words), dtype=np.uint64)
            for row, text in enumerate(batch.column("text")):
                found[row] = fingerprint(text.as_py() or "", shingle, words, seed)
            ones = np.bitwise_count(found).sum(axis=1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([row.tobytes() for row in found.astype(">u8")], pa.binary()),
                    pa.array(ones),
                    pa.array(_group(found, ones, radius)),
                ],
                names=["doc_id", "fp", "ones", "group"])

    return docs.select("doc_id", "text").mapInArrow(hashed, schema)


def fingerprint(text: str, shingle: int = SHINGLE, words: int = 1, seed: int = SEED) -> np.ndarray:
    """The SimHash of one text. Only A-Z are lower-cased, only ASCII blanks cut words."""
    return _majority(_hashes(text, shingle, seed), words)


def _hashes(text: str, shingle: int, seed: int = SEED) -> np.ndarray:
    """Hashes of all shingles, in their order."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    n = max(1, len(tokens) - shingle + 1)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(tokens)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), dtype=np.uint64, count=n)


def _majority(hashes: np.ndarray, words: int) -> np.ndarray:
    """The bits that are set in over half of the hashes."""
    n = len(hashes)
    ones = np.zeros(64 * words, dtype=np.int64)
    for at in range(0, n, _ROWS * 64):
        part = _widened(hashes[at:at + _ROWS * 64], words)
        bits = np.unpackbits(part.view(np.uint8), axis=1, bitorder="little")
        whole = len(bits) // _ROWS * _ROWS
        sums = bits[:whole].reshape(-1, _ROWS, 64 * words).sum(axis=1, dtype=np.uint8)
        ones += sums.sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > n, bitorder="little").view(np.uint64)


def _widened(hashes: np.ndarray, words: int) -> np.ndarray:
    """(n, words): the hashes, and more bits mixed from them."""
    out = np.empty((len(hashes), words), dtype=np.uint64)
    out[:, 0] = hashes
    for k in range(1, words):
        x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def _by_quarters(words: int, radius: int) -> bool:
    return words == 1 and radius <= 3


def _group(found: np.ndarray, ones: np.ndarray, radius: int) -> np.ndarray:
    if not _by_quarters(found.shape[1], radius):
        return ones // np.int32(radius + 1)
    quarters = np.bitwise_count(found.view(np.uint16).reshape(-1, 4)).astype(np.int32)
    return quarters @ np.array([1, 100, 100 ** 2, 100 ** 3], dtype=np.int32)


def _steps(words: int, radius: int) -> list:
    """From a group to those it has to meet, one of each two opposite steps."""
    if not _by_quarters(words, radius):
        return [0, 1]
    span = range(-radius, radius + 1)
    near = [[span[i] for i in at] for at in np.ndindex(*[len(span)] * 4)]
    near = [sum(d * 100 ** k for k, d in enumerate(at)) for at in near if sum(map(abs, at)) <= radius]
    return [step for step in near if step >= 0]


def _meetings(ids: DataFrame, words: int, radius: int, tile: int) -> DataFrame:
    """(rows, home_rows): every two tiles of ids that may hold near fingerprints, once."""
    ranked = before(ids, ["group"], F.floor(F.col("ones") * _BUCKETS / (64 * words + 1)),
                    ["ones", "fp"], F.lit(1), "rank")
    own = [c for c in ids.columns if c not in ("group", "ones")]
    tiles = keep(
        ranked.groupBy("group", F.expr(f"rank div {tile}").alias("tile")).agg(
            F.collect_list(F.struct(*own)).alias("rows"),
            F.min("ones").alias("low"), F.max("ones").alias("high")),
        "tiles")

    # A tile waits in one of about root-n cells of its group and visits every
    # cell of the groups near its own.
    cells = tiles.groupBy("group").agg(F.ceil(F.sqrt(F.count("*"))).cast("int").alias("cells"))
    cells = keep(cells, "cells")
    home = lookup_join(tiles, cells, "group").select(
        "group", (F.col("tile") % F.col("cells")).cast("int").alias("cell"),
        *(F.col(c).alias(f"home_{c}") for c in ("tile", "rows", "low", "high")))
    step = F.explode(F.array(*map(F.lit, _steps(words, radius))))
    visits = tiles.withColumn("step", step).withColumn("own", F.col("step") == 0)
    visits = visits.withColumn("group", F.col("group") + F.col("step"))
    visits = lookup_join(visits, cells, "group").withColumn(
        "cell", F.explode(F.expr("sequence(0, cells - 1)")))
    return visits.join(home, ["group", "cell"]).where(
        f"(not own or tile <= home_tile) and low <= home_high + {radius} and home_low <= high + {radius}"
    ).select("rows", "home_rows")


def near_links(ids: DataFrame, words: int = 1, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) links that span the classes of (id, fp, ones, group) rows, fp distinct.

    Every two fingerprints within the radius end up connected; two tiles give
    no more links than they have rows.
    """
    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                sides = [batch.column(c)[row].values for c in ("rows", "home_rows")]
                x, y = (_unpacked(side.field("fp"), words) for side in sides)
                i, j = map(np.concatenate, zip(*_near(x, y, radius)))
                both = np.concatenate([side.field("id").to_numpy() for side in sides])
                names, place = np.unique(both, return_inverse=True)
                a, b = spanning_links(place[i], place[len(x) + j], len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])],
                                                 names=["a", "b"])

    return _meetings(ids, words, radius, tile).mapInArrow(compare, "a BIGINT, b BIGINT")


def near_pairs(ids: DataFrame, words: int, radius: int, similarity: float, tile: int = TILE) -> DataFrame:
    """(a, b): all pairs of (id, fp, ones, group, size, root) rows within the radius.

    Not those of one root, nor of sets whose sizes rule the similarity out.
    """
    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                sides = [batch.column(c)[row].values for c in ("rows", "home_rows")]
                x, y = (_unpacked(side.field("fp"), words) for side in sides)
                (id_x, id_y), (size_x, size_y), (root_x, root_y) = (
                    [side.field(c).to_numpy() for side in sides] for c in ("id", "size", "root"))
                for i, j in _near(x, y, radius):
                    fits = (root_x[i] != root_y[j]) & _sizes_fit(size_x[i], size_y[j], similarity)
                    a, b = id_x[i[fits]], id_y[j[fits]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    # A tile that meets itself gives its pairs twice.
    return _meetings(ids, words, radius, tile).mapInArrow(compare, "a BIGINT, b BIGINT").distinct()


def _sizes_fit(x, y, similarity: float):
    """Whether sets of these sizes can have the Jaccard index; a little wider than exact."""
    return (x >= (similarity - 1e-9) * y) & (y >= (similarity - 1e-9) * x)


def _unpacked(fps, words: int) -> np.ndarray:
    return np.frombuffer(b"".join(fps.to_pylist()), dtype=">u8").astype(np.uint64).reshape(-1, words)


def _near(x: np.ndarray, y: np.ndarray, radius: int):
    """Index pairs, in parts, of x and y whose bits differ in no more than ``radius`` places.

    As many words first as tell unrelated ones apart: few pairs are left for the others.
    """
    words = x.shape[1]
    first = next((k for k in range(1, words) if 32 * k - 16 * math.sqrt(k) > radius), words)
    first = max(first, (words + 1) // 2)
    left, right = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    step = max(1, (1 << 18) // max(1, len(y)))
    for at in range(0, len(x), step):
        apart = np.bitwise_count(left[0, at:at + step, None] ^ right[0])
        for k in range(1, first):
            apart += np.bitwise_count(left[k, at:at + step, None] ^ right[k])
        i, j = (apart <= radius).nonzero()
        if len(i) and first < words:
            sure = np.bitwise_count(x[i + at] ^ y[j]).sum(axis=1) <= radius
            i, j = i[sure], j[sure]
        yield i + at, j


def simhash_classes(docs: DataFrame, shingle: int = SHINGLE, words: int = 1,
                    radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id): the least doc_id that near links reach.

    Null only where no row that is reached has a doc_id.
    """
    rows = keep(fingerprints(docs, shingle, words, radius), "fingerprints")
    ids = rows.groupBy("fp", "ones", "group").agg(F.min("doc_id").alias("least"))
    ids = keep(ids.withColumn("id", F.monotonically_increasing_id()), "ids")
    roots = components(near_links(ids.drop("least"), words, radius, tile))
    classes = ids.join(roots, "id", "left").select(
        "fp", "least", F.coalesce("root", "id").alias("root"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = keep(classes.join(least, "root").select("fp", "component_id"), "classes")
    return lookup_join(rows, named, "fp", "left").select("doc_id", "fp", "component_id")


def sketches(docs: DataFrame, shingle: int, words: int, radius: int, seed: int = SEED) -> DataFrame:
    """(doc_id, name, size, least, fp, ones, group) of the distinct shingles of each text.

    name is a hash of the set, size its number of shingles and least the least
    hash under each of ``words`` mixings, empty for a text without words.
    """
    schema = docs.select(
        "doc_id", F.lit(b"").alias("name"), F.lit(0).cast("bigint").alias("size"),
        F.array().cast("array<bigint>").alias("least"), F.lit(b"").alias("fp"), F.lit(0).alias("ones"),
        F.lit(0).alias("group")).schema

    def sketched(batches):
        for batch in batches:
            found = np.zeros((batch.num_rows, words), dtype=np.uint64)
            names, sizes, least = [], [], []
            for row, text in enumerate(batch.column("text")):
                held = np.unique(_hashes(text.as_py() or "", shingle, seed))
                found[row] = _majority(held, words)
                names.append(xxhash.xxh3_128_digest(held.tobytes()))
                sizes.append(len(held))
                least.append(_least(held, words))
            ones = np.bitwise_count(found).sum(axis=1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()),
                    pa.array(least, pa.list_(pa.int64())),
                    pa.array([row.tobytes() for row in found.astype(">u8")], pa.binary()),
                    pa.array(ones), pa.array(_group(found, ones, radius)),
                ],
                names=["doc_id", "name", "size", "least", "fp", "ones", "group"])

    return docs.select("doc_id", "text").mapInArrow(sketched, schema)


def _least(hashes: np.ndarray, words: int) -> list:
    if not len(hashes):
        return []
    parts = range(0, len(hashes), _ROWS * 64)
    return np.min([_widened(hashes[at:at + _ROWS * 64], words).min(axis=0) for at in parts],
                  axis=0).view(np.int64).tolist()


def verified(pairs: DataFrame, ids: DataFrame, docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The (a, b) pairs of ids whose sets of shingles have the Jaccard index at least."""
    def packed(batches):
        for batch in batches:
            held = [np.unique(_hashes(t.as_py() or "", shingle)).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(held, pa.large_binary())],
                                             names=["id", "held"])

    pairs = keep(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = wanted.join(ids.select("id", F.col("least_id").alias("doc_id")), "id")
    texts = lookup_join(docs.select("doc_id", "text"), keep(wanted, "wanted"), "doc_id").dropDuplicates(["id"])
    sets = keep(texts.select("id", "text").mapInArrow(packed, "id BIGINT, held BINARY"), "sets")
    for side in ("a", "b"):
        own = sets.select(F.col("id").alias(side), F.col("held").alias(f"held_{side}"))
        # Sets have the size of their texts, which lookups do not weigh.
        pairs = lookup_join(pairs, own, side, small=False)

    def compare(batches):
        for batch in batches:
            near = []
            for x, y in zip(batch.column("held_a"), batch.column("held_b")):
                x, y = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= (similarity - 1e-9) * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.mapInArrow(compare, "a BIGINT, b BIGINT")


def near_copy_classes(docs: DataFrame, shingle: int, words: int, radius: int, similarity: float,
                      tile: int = TILE) -> DataFrame:
    """(doc_id, component_id): the least doc_id that verified links reach.

    Equal sets of shingles are one class; doc_id must tell texts apart.
    """
    docs = docs.select("doc_id", "text")
    rows = keep(sketches(docs, shingle, words, radius), "sketches")
    ids = rows.groupBy("name", "size", "least", "fp", "ones", "group").agg(F.min("doc_id").alias("least_id"))
    ids = keep(ids.withColumn("id", F.monotonically_increasing_id()), "ids")

    # One link at most per text and least hash, to the first text that has it.
    heads = keep(ids.select("id", "size", F.explode("least").alias("head")), "heads")
    first = heads.groupBy("head").agg(F.min(F.struct("id", "size")).alias("first"), F.count("*").alias("n"))
    first = keep(first.where("n > 1").select(
        "head", F.col("first.id").alias("a"), F.col("first.size").alias("size_a")), "first")
    star = lookup_join(heads, first, "head").where(
        (F.col("a") != F.col("id")) & _sizes_fit(F.col("size"), F.col("size_a"), similarity))
    star = keep(verified(star.select("a", F.col("id").alias("b")).distinct(), ids, docs, shingle, similarity), "star")

    labelled = ids.join(components(star), "id", "left").select(
        "id", "fp", "ones", "group", "size", F.coalesce("root", "id").alias("root"))
    pairs = near_pairs(keep(labelled, "labelled"), words, radius, similarity, tile)
    links = star.unionByName(verified(pairs, ids, docs, shingle, similarity))
    classes = ids.join(components(links), "id", "left").select(
        "name", "least_id", F.coalesce("root", "id").alias("root"))
    least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = keep(classes.join(least, "root").select("name", "component_id"), "classes")
    return lookup_join(rows, named, "name", "left").select("doc_id", "component_id")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each class of near copies stays: the one with the least doc_id.

    Classes are those of the fingerprints, as simhash_classes() tells them, or, with a
    similarity, those of near_copy_classes(). Rows alike in id and text count as one document.
    """
    classes_of = near_copy_classes if "similarity" in options else simhash_classes
    key = F.xxhash64("doc_id", "text").alias("_key")
    classes = classes_of(docs.select(key.alias("doc_id"), "text"), **options)
    ids = docs.select(key, "doc_id").groupBy("_key").agg(
        F.min("doc_id").alias("_id"), F.count("*").alias("_rows"))
    first = classes.select(F.col("doc_id").alias("_key"), "component_id").distinct().join(ids, "_key")
    first = first.groupBy("component_id").agg(
        F.min(F.struct(F.col("_id").isNull(), "_id", "_key", "_rows")).alias("first"))
    first = keep(first.select("first._key", "first._rows"), "kept")
    # The columns of the documents travel in one, so no name of theirs is met.
    packed = docs.select(F.struct("*").alias("row"), key)
    kept = lookup_join(packed, first, "_key")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64("row")))
    several = kept.where("_rows > 1").withColumn("_nth", nth).where("_nth = 1")
    return kept.where("_rows = 1").select("row.*").unionByName(several.select("row.*"))
