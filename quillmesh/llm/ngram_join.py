"""Documents whose sets of word n-grams are alike, by trees over count vectors.

Hashed n-grams fall into groups by hash ranges. The counts of a document's groups
are a point; two sets share no more than the sum of the lesser counts, coordinate
by coordinate, and nodes of points no more than that of their greatest counts.

One tree over all points would prune by size only: in many dimensions unrelated
texts of one size lie closer together than the radius. So points are dealt to
many small trees first, without losing a pair. Sizes form classes, and a class
has more groups than sets of its sizes may differ in, so two sets that are alike
have a group in common, n-gram by n-gram. A document goes to the tree of each of
its groups' contents in its own class, and as a guest to those of the next class
if it is large enough to meet it. Trees of one document alone are dropped.

In a tree all documents are held against the least one and a few others first,
which connects groups of copies by a few times as many pairs as they have members. Those that this leaves
apart are packed by size into leaves; leaves that pass the bound meet, points
that pass it are pairs, and pairs are verified by their n-grams.

Defined cases: a null or blank text has the empty set and is linked with nothing;
fewer words than n make one n-gram; equal sets are linked; repeated rows come
out as often as they come; a null doc_id takes part, and component_id is null
only where no reachable row has a doc_id. An empty table gives no rows. Columns
other than doc_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep
from .common import before
from .components import components

WORDS = 4
ALIKE = 85  # 100 * shared >= ALIKE * all
LEAF = 256
_CENTRES = 5
_GROWTH = 1.7  # of the sizes of a class; larger ones need more groups, smaller ones more guests
_COORDINATES = (8, 512)
_REMEMBERED = 100_000  # hashes of short words
_SHORT = 64
_BATCH = 8 << 20  # bytes of sets in a batch on their way out
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word):
        code = xxhash.xxh3_64_intdigest(word)
        if len(word) <= _SHORT:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = code
        return code


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """The sorted hashes of the distinct n-grams. Only A-Z are lower-cased, only ASCII blanks cut words."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    n = min(words, len(codes))
    grams = np.full(len(codes) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        grams = grams * _MULTIPLIER + codes[k:len(codes) - n + 1 + k]
    return np.unique(_mixed(grams))


class Classes:
    """Classes of sizes, and the groups that a set of each falls into."""

    def __init__(self, alike: int):
        self.alike = alike
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(max(starts[-1] + 1, int(starts[-1] * _GROWTH)))
        self.starts = np.array(starts)

    def of(self, size: int) -> list:
        """The own class, and the next one if a set of its least size may be alike."""
        own = int(np.searchsorted(self.starts, size, "right")) - 1
        return [own, own + 1] if 100 * size >= self.alike * int(self.starts[own + 1]) else [own]

    def groups(self, k: int) -> tuple[int, int]:
        """Groups of class ``k``, and how many of them may be empty and unsaid."""
        # Alike sets of m n-grams together differ in (100 - alike) / (100 + alike) m at most.
        apart = (100 - self.alike) * 2 * (int(self.starts[k + 1]) - 1) // (100 + self.alike)
        spare = apart // 16 + 1 if apart else 0
        return apart + 1 + spare, spare

    def coordinates(self, k: int) -> int:
        # One to an n-gram of small sets, so that few n-grams that differ are taken for shared ones.
        most = int(self.starts[k + 1])
        return int(np.clip(max(most // 2, min(most, _COORDINATES[1] // 2)), *_COORDINATES))

    def trees(self, held: np.ndarray, k: int) -> np.ndarray:
        """Names of the trees of a set in class ``k``: hashes of the contents of its groups."""
        groups, spare = self.groups(k)
        edges = np.searchsorted(_group(held, groups), np.arange(groups + 1))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(held, dtype=np.uint64)])
        names = _mixed(sums[edges[1:]] - sums[edges[:-1]] + np.arange(groups, dtype=np.uint64) * _MULTIPLIER)
        empty = edges[1:] == edges[:-1]
        # Two sets have more equal groups than ``spare``. Only if one has no more
        # empty groups than that, one of the equal ones is sure not to be empty.
        if empty.sum() <= spare:
            names = names[~empty]
        return _mixed(names ^ np.uint64(k))

    def point(self, held: np.ndarray, k: int) -> np.ndarray:
        """Counts of a byte each, of four where one is too large for that."""
        n = self.coordinates(k)
        counts = np.bincount(_group(held, n), minlength=n)
        return counts.astype(np.uint8 if counts.max() < 256 else np.uint32)

    def points(self, held: list, k: int) -> np.ndarray:
        n = self.coordinates(k)
        if all(len(x) == n for x in held):
            return np.frombuffer(b"".join(held), dtype=np.uint8).reshape(len(held), n)
        return np.stack([np.frombuffer(x, dtype=np.uint8 if len(x) == n else np.uint32).astype(np.uint32) for x in held])

    def shared(self, a, b):
        """How many n-grams sets of these sizes have to share."""
        return -(-self.alike * (a + b) // (100 + self.alike))


def _group(held: np.ndarray, groups: int) -> np.ndarray:
    return ((held >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def sketches(docs: DataFrame, words: int = WORDS, alike: int = ALIKE) -> DataFrame:
    """(row, doc_id, key, name, size, k, own, own_point, next, next_point) of every document.

    ``key`` tells the text, ``name`` the set, ``k`` its class; own and next are names of trees.
    """
    lists = pa.list_(pa.int64())
    names = ["row", "doc_id", "key", "name", "size", "k", "own", "own_point", "next", "next_point"]
    schema = "row BIGINT, doc_id {}, key BINARY, name BINARY, size BIGINT, k INT, own ARRAY<BIGINT>, " \
        "own_point BINARY, next ARRAY<BIGINT>, next_point BINARY".format(docs.schema["doc_id"].dataType.simpleString())

    def sketched(batches):
        hashes, classes = _Hashes(), Classes(alike)
        for batch in batches:
            # A few hundred texts at once: the lists of trees are a quarter of their size.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = [[] for _ in names[3:]]
                for text in part.column("text"):
                    held = ngrams(text.as_py(), words, hashes)
                    own = classes.of(len(held)) if len(held) else []
                    row = [xxhash.xxh3_128_digest(held.tobytes()), len(held), *own[:1]]
                    for k in own:
                        row += [classes.trees(held, k).view(np.int64), classes.point(held, k).tobytes()]
                    for column, value in zip(out, row + [None] * (len(out) - len(row))):
                        column.append(value)
                kinds = (pa.binary(), pa.int64(), pa.int32(), lists, pa.binary(), lists, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names[:3]), *map(pa.array, out, kinds)], names=names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _key(), "text")
    return rows.mapInArrow(sketched, schema)


def _key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key")


def ngram_classes(docs: DataFrame, words: int = WORDS, alike: int = ALIKE, leaf: int = LEAF) -> DataFrame:
    """(doc_id, n_shingles, component_id): the least doc_id that links reach."""
    docs = docs.select("doc_id", "text")
    rows = keep(sketches(docs, words, alike), "sketches")
    some = rows.where("size > 0").groupBy("name").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("least"), F.count("*").alias("_rows"))
    some = keep(some, "names")
    # Sketches are large: they stay where they are while the ids can be broadcast.
    first = some.select("row", F.lit(1).cast("bigint").alias("_rows"))
    sets = lookup_join(rows, first.select("row"), "row", counts=first)
    sets = keep(sets.withColumnRenamed("row", "id"), "sets")

    roots = keep(components(links_of(sets, docs, words, alike, leaf)).withColumnRenamed("id", "row"), "roots")
    roots = keep(roots.join(some.select("row", "least"), "row"), "linked")
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("_rows"))
    least = keep(least, "least")
    linked = lookup_join(roots.select("row", "root"), least.select("root", "component_id"), "root",
                         counts=least.select("root", "_rows"))
    classes = some.join(linked, "row", "left").select(
        "name", "_rows", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id"))
        .alias("component_id"))
    classes = keep(classes, "classes")
    # As many names as sets, and as many trees further down: never broadcast.
    found = lookup_join(rows.select("doc_id", "name", "size"), classes.select("name", "component_id"), "name",
                        "left", small=False, counts=classes.select("name", "_rows"))
    own = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"))


def links_of(sets: DataFrame, docs: DataFrame, words: int, alike: int, leaf: int = LEAF) -> DataFrame:
    """(a, b) links between ids of sets that connect all that are alike."""
    # The id and, in the lowest bit, whether the tree is of the own class: one number to a row.
    def coded(trees: str, home: int):
        code = (F.col("id") * 2 + home).alias("code")
        return F.transform(F.coalesce(trees, F.array()), lambda t: F.struct(t.alias("tree"), code))

    placed = sets.select(F.explode(F.concat(coded("own", 1), coded("next", 0))).alias("t")).select("t.*")
    # Dealt by tree once. Nearly all trees have one member, and no set is in a tree twice, so the rows
    # of a tree are no more than the sets.
    tree = Window.partitionBy("tree")
    shared = placed.select(
        "tree", "code", F.count("*").over(tree).alias("_rows"), F.min("code").over(tree).alias("first"),
        F.max(F.col("code") % 2).over(tree).alias("_home")).where("_rows > 1 AND _home = 1")
    members = shared.select("tree", F.shiftright("code", 1).alias("id"), (F.col("code") % 2 == 1).alias("home"),
                            F.shiftright("first", 1).alias("first"))
    members = keep(members.where("first <> id"), "members")
    star = members.select(F.col("first").alias("a"), F.col("id").alias("b"))
    # Copies at the edge are alike to some of their group only: a few more centres,
    # the same ones in most trees, connect them as well.
    centres = members.groupBy("tree").agg(F.count("*").alias("_rows"), F.array(
        *(F.min_by("id", F.xxhash64(F.lit(at), "id")) for at in range(_CENTRES))).alias("centres"))
    centres = keep(centres.where("_rows > 1"), "centres")
    others = lookup_join(members.select("tree", "id"), centres.select("tree", "centres"), "tree", small=False,
                         counts=centres.select("tree", "_rows"))
    others = others.select("id", F.explode("centres").alias("centre")).where("id <> centre")
    star = star.unionByName(others.select(
        F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))).distinct()
    ids = members.select("id").unionByName(members.select(F.col("first").alias("id"))).distinct()
    star = keep(verified(bounded(star, ids, sets, alike), sets, docs, words, alike), "star")

    # Trees whose members the stars left apart.
    # A document is in no more trees than it has groups: plain joins on ids do.
    rest = keep(members.join(components(star), "id", "left").select(
        "tree", "id", "home", F.coalesce("root", "id").alias("root")), "rest")
    apart = rest.groupBy("tree").agg(
        F.count("*").alias("_rows"), F.bool_or("home").alias("home"),
        (F.min("root") < F.max("root")).alias("apart"))
    apart = keep(apart.where("apart AND home").select("tree", "_rows"), "apart")
    rest = lookup_join(rest, apart.select("tree"), "tree", small=False, counts=apart)
    pairs = tree_pairs(rest, sets, alike, leaf)
    return star.unionByName(verified(pairs, sets, docs, words, alike))


def bounded(pairs: DataFrame, ids: DataFrame, sets: DataFrame, alike: int) -> DataFrame:
    """The (a, b) pairs, both among the distinct ids, whose sizes and points let them be alike."""
    pairs = keep(pairs, "starred")
    wanted = keep(ids, "ends")
    points = keep(sets.select("id", "size", "k", "own_point", "next_point").join(wanted, "id"), "points")
    for side in ("a", "b"):
        own = points.select(*(F.col(c).alias(side if c == "id" else f"{c}_{side}") for c in points.columns))
        # Points have about the size of their texts: never broadcast.
        pairs = lookup_join(pairs, own, side, small=False)

    def compare(batches):
        classes = Classes(alike)
        for batch in batches:
            fits = []
            for row in batch.drop_columns(["a", "b"]).to_pylist():
                k = max(row["k_a"], row["k_b"])
                x, y = (row[f"own_point_{s}"] if row[f"k_{s}"] == k else row[f"next_point_{s}"] for s in ("a", "b"))
                fits.append(x is not None and y is not None
                            and classes.shared(row["size_a"], row["size_b"])
                            <= np.minimum(*classes.points([x, y], k)).sum(dtype=np.int64))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    return pairs.mapInArrow(compare, "a BIGINT, b BIGINT")


def tree_pairs(members: DataFrame, sets: DataFrame, alike: int, leaf: int = LEAF) -> DataFrame:
    """(a, b) pairs of one tree that have two roots and pass the bound."""
    points = members.join(sets.select("id", "size", "k"), "id")
    # Sizes grow by a tenth or so from bucket to bucket, so a large tree is ranked by several tasks.
    bucket = F.floor(F.log2(F.col("size")) * 8) * 64 + F.pmod("id", F.lit(64))
    ranked = before(points, ["tree"], bucket, ["size", "id"], F.lit(1), "rank")
    # Points join when all else is done.
    ranked = ranked.join(sets.select("id", "own_point", "next_point"), "id").select(
        "tree", F.expr(f"rank div {leaf}").alias("leaf"), "id", "root", "home", "size",
        F.when(F.col("home"), F.col("k")).otherwise(F.col("k") + 1).alias("k"),
        F.when(F.col("home"), F.col("own_point")).otherwise(F.col("next_point")).alias("point"))
    row = F.struct("id", "root", "home", "size", "k", "point")
    leaves = keep(ranked.groupBy("tree", "leaf").agg(F.collect_list(row).alias("rows")), "leaves")
    # A leaf waits in one of about root-n cells of its tree and visits all of them.
    cells = leaves.groupBy("tree").agg(F.ceil(F.sqrt(F.count("*"))).cast("int").alias("cells"))
    cells = keep(cells, "cells")
    dealt = lookup_join(leaves, cells, "tree")
    home = dealt.select("tree", (F.col("leaf") % F.col("cells")).cast("int").alias("cell"),
                        F.col("leaf").alias("home_leaf"), F.col("rows").alias("home_rows"))
    visits = dealt.withColumn("cell", F.explode(F.expr("sequence(0, cells - 1)")))
    met = visits.join(home, ["tree", "cell"]).where("leaf <= home_leaf").select("rows", "home_rows")

    def passing(batches):
        classes = Classes(alike)
        for batch in batches:
            for row in range(batch.num_rows):
                sides = (batch.column(c)[row].values for c in ("rows", "home_rows"))
                yield _passing(*sides, classes)

    return met.mapInArrow(passing, "a BIGINT, b BIGINT").distinct()


def _passing(left, right, classes: Classes):
    """The pairs of points of two leaves that the summed minima let through."""
    (x, n_x, id_x, root_x, home_x), (y, n_y, id_y, root_y, home_y) = (
        _leaf(rows, classes) for rows in (left, right))
    a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    # Nodes first: their greatest counts against their least sizes.
    if np.minimum(x.max(axis=0), y.max(axis=0)).sum(dtype=np.int64) >= classes.shared(n_x.min(), n_y.min()):
        for k in range(len(x)):
            near = (100 * n_y >= classes.alike * n_x[k]) & (100 * n_x[k] >= classes.alike * n_y)
            near &= (root_y != root_x[k]) & (home_y | home_x[k])
            j = np.flatnonzero(near)
            j = j[np.minimum(y[j], x[k]).sum(axis=1, dtype=np.int64) >= classes.shared(n_y[j], n_x[k])]
            a.append(np.minimum(id_y[j], id_x[k]))
            b.append(np.maximum(id_y[j], id_x[k]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def _leaf(rows, classes: Classes):
    points = classes.points(rows.field("point").to_pylist(), rows.field("k")[0].as_py())
    ids = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("size", "id", "root", "home"))
    return points, *ids


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int, alike: int) -> DataFrame:
    """The (a, b) pairs of ids whose sets are alike."""
    def packed(batches):
        hashes = _Hashes()
        for batch in batches:
            ids, held, size = [], [], 0
            for at, (id_, text) in enumerate(zip(batch.column("id").to_pylist(), batch.column("text"))):
                ids.append(id_)
                held.append(ngrams(text.as_py(), words, hashes).tobytes())
                size += len(held[-1])
                if size > _BATCH or at + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.binary())],
                                                     names=["id", "held"])
                    ids, held, size = [], [], 0

    pairs = keep(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = keep(sets.select("id", "key").join(wanted, "id"), "wanted")
    texts = lookup_join(docs.select(_key(), "text"), wanted.select("key", "id"), "key").dropDuplicates(["id"])
    held = keep(texts.select("id", "text").mapInArrow(packed, "id BIGINT, held BINARY"), "held")
    for side in ("a", "b"):
        own = held.select(F.col("id").alias(side), F.col("held").alias(f"held_{side}"))
        # Sets have the size of their texts: never broadcast.
        pairs = lookup_join(pairs, own, side, small=False)

    def compare(batches):
        for batch in batches:
            near = []
            for x, y in zip(batch.column("held_a"), batch.column("held_b")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(100 * both >= alike * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.mapInArrow(compare, "a BIGINT, b BIGINT")
