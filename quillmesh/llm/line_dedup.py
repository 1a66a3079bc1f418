"""Lines that equal or nearly equal an earlier line, by edit distance.

Two lines within a threshold of t edits share one of t + 1 segments of the
shorter one, a little moved at most. Every line sends the segments it is cut
into, and the parts of it that may equal a segment of a line of its own length
or up to t characters shorter, by hash. Where both meet, lines whose character
pairs differ too much for t edits are told apart by exclusive-or and bit
counts, and the rest is verified by a banded bit-parallel edit distance over
the texts. Lines that links connect are one class; the first one stays.

Segments that very many lines share are found in a sample and dealt to a grid
of cells, where every two of their lines meet. The grid of a segment grows with
its lines, so a cell holds about twice ``HOT_LINES`` of them at most.

Defined cases: lines are cut at newlines; lines under ``MIN_CHARS`` characters
are matched only if equal, and only from ``exact_from`` characters on (the
query and the pipeline pass 1); shorter or blank ones are never looked at or
removed; equal lines are one class by hash; a null text
stays null; documents stay, if need be with an empty text; repeated rows are
repeats like any other, the first by (doc_id, text) keeps the line and equal
rows keep it together; an empty table gives no rows. Only doc_id and text are
looked at; where n_chars is there, the new length is put in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep
from .components import components

EDITS = 2
MIN_CHARS = 24
SAMPLE = 64  # one line of so many tells which segments are hot
HOT_LINES = 20_000  # lines with a segment, about, beyond which it is dealt out
_SEEN = 500_000  # hashes of lines that a task remembers, to send each once
_SEED = 42

_KEYS = "key BIGINT, line BIGINT, sign BIGINT, own BOOLEAN"


def segments(n: int, edits: int) -> list:
    """(start, length) of the edits + 1 segments of a line of n characters."""
    least, longer = divmod(n, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        size = least + (i >= edits + 1 - longer)
        out.append((at, size))
        at += size
    return out


def probes(n: int, edits: int) -> list:
    """(length, segment, start, size): parts of a line of n characters that can
    equal a segment of a line of that length, without missing a near line.

    Its own segments, which are such parts too, are left out.
    """
    out = []
    for length in range(max(0, n - edits), n + 1):
        gap = n - length
        for i, (at, size) in enumerate(segments(length, edits)):
            # A part may move by the edits left of it, and by those right of it.
            low = max(at - i, at + gap - (edits - i), 0)
            high = min(at + i, at + gap + (edits - i), n - size)
            out += [(length, i, start, size) for start in range(low, high + 1) if gap or start != at]
    return out


def _signs(line: str) -> int:
    """Parities of 64 classes of character pairs; an edit changes four at most."""
    c = np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32)
    pairs = (c[:-1] * np.uint32(0x9E3779B1) ^ c[1:] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D)
    counts = np.bincount(pairs >> np.uint32(26), minlength=64)
    return int(np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)[0])


def line_table(docs: DataFrame, min_chars: int, exact_from: int = MIN_CHARS) -> DataFrame:
    """(doc_id, uid, at, line, check): a row per line that is looked at.

    line and check are two hashes of it. uid stands for (doc_id, text).
    """
    uid = F.xxhash64("doc_id", "text").alias("uid")
    each = docs.select("doc_id", uid, F.posexplode(F.split("text", "\n", -1)).alias("at", "text"))
    short = (F.length("text") >= exact_from) & F.col("text").rlike(r"\S")
    each = each.where((F.length("text") >= min_chars) | short)
    return each.select("doc_id", "uid", "at", F.xxhash64("text").alias("line"),
                       F.xxhash64(F.lit("check"), "text").alias("check"))


def segment_keys(docs: DataFrame, edits: int, min_chars: int, share: int = 1) -> DataFrame:
    """(key, line, sign, own): a row per segment (own) and per part that may equal one.

    With ``share``, only lines of one hash in so many.
    """
    def keys(batches):
        shapes: dict = {}
        seen: set = set()
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            found, lines, signs, own = [], [], [], []
            for text in batch.column("text"):
                for line in (text.as_py() or "").split("\n"):
                    n = len(line)
                    if n < min_chars:
                        continue
                    name = digest(line, _SEED)
                    if name % share or name in seen:
                        continue
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(name)
                    if n not in shapes:
                        own_parts = [(i + (n << 8), a, a + s) for i, (a, s) in enumerate(segments(n, edits))]
                        shapes[n] = (len(own_parts), own_parts + [
                            (i + (length << 8), a, a + s) for length, i, a, s in probes(n, edits)])
                    count, parts = shapes[n]
                    found += [digest(line[a:b], seed) for seed, a, b in parts]
                    lines.append((name, len(parts), count))
                    signs.append(_signs(line))
            if not lines:
                continue
            names, sizes, counts = (np.array(x, dtype=np.uint64) for x in zip(*lines))
            sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            own = np.arange(len(found)) - first < np.repeat(counts, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(found, dtype=np.uint64).view(np.int64)),
                 pa.array(np.repeat(names.view(np.int64), sizes)),
                 pa.array(np.repeat(np.array(signs, dtype=np.int64), sizes)), pa.array(own)],
                names=["key", "line", "sign", "own"])

    return docs.select("text").mapInArrow(keys, _KEYS)


def dealt(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows with a cell; rows of hot (key, parts) go to as many cells as parts.

    Part p of a hot key meets part q in the one cell (least, greatest).
    """
    rows = lookup_join(rows, hot, "key", "left")
    part = F.pmod("line", "parts")
    others = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1),
                         lambda q: F.least(part, q) * F.col("parts") + F.greatest(part, q))
    cells = F.when(F.col("parts").isNotNull(), others).otherwise(F.array(F.lit(-1).cast("bigint")))
    return rows.withColumn("cell", F.explode(cells)).drop("parts")


def candidates(docs: DataFrame, edits: int, min_chars: int, hot_lines: int = HOT_LINES) -> DataFrame:
    """(a, b): pairs of different lines that share a segment and have close signs."""
    sample = segment_keys(docs, edits, min_chars, SAMPLE).groupBy("key").agg(F.count("*").alias("n"))
    hot = sample.where(F.col("n") * SAMPLE > hot_lines)
    hot = keep(hot.select("key", F.ceil(F.col("n") * SAMPLE / hot_lines).cast("bigint").alias("parts")), "hot")
    met = dealt(segment_keys(docs, edits, min_chars), hot)
    met = met.repartition("key", "cell").sortWithinPartitions("key", "cell")
    most = 4 * edits

    def meet(batches):
        rest = None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cell", "line", "sign", "own")]
            if rest is not None:
                columns = [np.concatenate(pair) for pair in zip(rest, columns)]
            key, cell = columns[:2]
            if not len(key):
                continue
            # The last group may go on in the next batch.
            open_at = len(key) - int(np.argmax((key[::-1] != key[-1]) | (cell[::-1] != cell[-1])))
            if open_at == len(key) and ((key == key[0]) & (cell == cell[0])).all():
                open_at = 0
            rest = [c[open_at:] for c in columns]
            yield from _met([c[:open_at] for c in columns], most)
        if rest is not None:
            yield from _met(rest, most)

    return met.mapInArrow(meet, "a BIGINT, b BIGINT").distinct()


def _met(columns: list, most: int):
    """Pairs of a segment's line and a line with an equal part, signs close.

    A line's segments are among its parts. Most segments are of one line alone.
    """
    key, cell, line, sign, own = columns
    if not len(key):
        return
    turns = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
    starts = np.concatenate([[0], turns])
    ends = np.concatenate([turns, [len(key)]])
    shared = np.logical_or.reduceat(own, starts)
    shared &= np.minimum.reduceat(line, starts) != np.maximum.reduceat(line, starts)
    out = []
    for a, b in zip(starts[shared].tolist(), ends[shared].tolist()):
        theirs, at = np.unique(line[a:b], return_index=True)
        other = sign[a:b][at].view(np.uint64)
        mine, at = np.unique(line[a:b][own[a:b]], return_index=True)
        signs = sign[a:b][own[a:b]][at].view(np.uint64)
        step = max(1, (1 << 20) // len(other))
        for first in range(0, len(mine), step):
            near = np.bitwise_count(signs[first:first + step, None] ^ other[None, :]) <= most
            i, j = near.nonzero()
            x, y = mine[i + first], theirs[j]
            out.append((np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]))
    if out:
        a, b = (np.concatenate(side) for side in zip(*out))
        pairs = np.unique(np.column_stack([a, b]), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())],
                                         names=["a", "b"])


def edit_distance(x: str, y: str, most: int) -> int:
    """The edit distance of two texts, or most + 1 if it is greater.

    A column of the table is a pair of bit vectors over the band of rows around
    the diagonal; bit 0 is the highest row.
    """
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > most:
        return most + 1
    start = 0
    while start < len(y) and x[start] == y[start]:
        start += 1
    end = 0
    while end < len(y) - start and x[len(x) - 1 - end] == y[len(y) - 1 - end]:
        end += 1
    x, y = x[start:len(x) - end], y[start:len(y) - end]
    if not y:
        return len(x)
    m, n = len(y), len(x)
    width = 2 * most + 1
    full = (1 << width) - 1
    # Places of each character of y, moved by the rows above the first one.
    at: dict = {}
    for i, char in enumerate(y):
        at[char] = at.get(char, 0) | 1 << (i + most)
    up = full ^ ((1 << most) - 1)  # rows that are one more than the row above
    down = 0
    # The lowest row of the band counts until the band passes the last row.
    row = score = min(most, m)
    for j, char in enumerate(x):
        equal = (at.get(char, 0) >> j) & full
        zero = ((((equal & up) + up) ^ up) | equal | down) & full
        grows = (down | (full & ~(zero | up))) & full
        falls = zero & up
        if row < m:
            row += 1
            score += not zero >> (width - 1) & 1
        else:
            bit = m + most - 1 - j
            if bit < 0:
                return most + 1
            score += (grows >> bit & 1) - (falls >> bit & 1)
        up = (falls | (full & ~((zero >> 1) | grows))) & full
        down = (zero >> 1) & grows
    return min(score, most + 1)


def near_lines(docs: DataFrame, lines: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS,
               hot_lines: int = HOT_LINES) -> DataFrame:
    """(a, b): links between different lines within the edit distance."""
    pairs = keep(candidates(docs, edits, min_chars, hot_lines), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    # The first place of every line that has a candidate, then its text.
    places = lookup_join(lines, keep(wanted, "wanted"), "line").groupBy("line").agg(
        F.min(F.struct("uid", "at")).alias("place"))
    places = places.groupBy("place.uid").agg(F.collect_list(F.struct("place.at", "line")).alias("lines"))
    texts = lookup_join(docs.select(F.xxhash64("doc_id", "text").alias("uid"), "text"),
                        keep(places, "places"), "uid")
    split = F.split("text", "\n", -1)
    found = texts.select(split.alias("all"), F.explode("lines").alias("l")).select(
        F.col("l.line").alias("line"), F.element_at("all", F.col("l.at") + 1).alias("text"))
    found = keep(found.groupBy("line").agg(F.min("text").alias("text")), "texts")
    for side in ("a", "b"):
        own = found.select(F.col("line").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = lookup_join(pairs, own, side)

    def verify(batches):
        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("text_a", "text_b"))
            near = pa.array([edit_distance(p, q, edits) <= edits for p, q in zip(x, y)], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    return pairs.mapInArrow(verify, "a BIGINT, b BIGINT")


def repeated_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS,
                   hot_lines: int = HOT_LINES, exact_from: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(uid, at) of the lines to remove, and (line, links, class) of lines with near ones.

    The first of a class in the order of (doc_id, uid, at) stays; a null doc_id
    comes last.
    """
    docs = docs.select("doc_id", "text")
    lines = keep(line_table(docs, min_chars, min_chars if exact_from is None else exact_from), "lines")
    links = keep(near_lines(docs, lines, edits, min_chars, hot_lines), "links")
    roots = keep(components(links), "classes")
    degrees = links.select(F.explode(F.array("a", "b")).alias("line")).groupBy("line").agg(
        F.count("*").alias("links"))
    classes = roots.withColumnRenamed("id", "line").join(degrees, "line").withColumnRenamed("root", "class")
    # A line without links is its own class; check tells lines of one hash apart.
    named = lookup_join(lines, roots.withColumnRenamed("id", "line"), "line", "left").select(
        "doc_id", "uid", "at", F.coalesce("root", "line").alias("class"),
        F.when(F.col("root").isNull(), F.col("check")).otherwise(0).alias("check"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "at")
    first = named.groupBy("class", "check").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = keep(first.where("n > 1").select(
        F.xxhash64("class", "check").alias("id"), "first.uid", "first.at"), "first")
    kept = first.withColumnRenamed("uid", "first_uid").withColumnRenamed("at", "first_at")
    removed = lookup_join(named.select(F.xxhash64("class", "check").alias("id"), "uid", "at"), kept, "id")
    removed = removed.where("uid <> first_uid OR at <> first_at").select("uid", "at")
    return removed.distinct(), classes


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """The documents without the lines that an earlier line makes needless."""
    removed, _ = repeated_lines(docs, **options)
    lists = keep(removed.groupBy("uid").agg(F.collect_list("at").alias("_gone")), "removed")
    # The columns of the documents travel in one, so no name of theirs is met.
    packed = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("uid"))
    marked = lookup_join(packed, lists, "uid", "left")
    left = F.filter(F.split("row.text", "\n", -1), lambda line, i: ~F.array_contains("_gone", i))
    cut = F.when(F.col("_gone").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    columns = {"text": cut}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("_gone").isNull(), F.col("row.n_chars")).otherwise(
            F.length(cut).cast(docs.schema["n_chars"].dataType))
    return marked.select(*(columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_links, class_id) per document.

    n_lines counts lines that are looked at. n_links are the near but different
    lines that they have, class_id the least class of those lines, null for none.
    """
    options = {"min_chars": MIN_CHARS, "exact_from": None} | options
    exact_from = options["min_chars"] if options["exact_from"] is None else options["exact_from"]
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("uid"))
    removed, classes = repeated_lines(docs, **options)
    gone = removed.groupBy("uid").agg(F.count("*").alias("n_removed"))
    lines = keep(line_table(docs, options["min_chars"], exact_from), "lines")
    found = lookup_join(lines.select("uid", "at", "line").distinct(), keep(classes, "links"), "line", "left")
    sums = found.groupBy("uid").agg(F.count("*").alias("n_lines"), F.sum("links").alias("n_links"),
                                    F.min("class").alias("class_id"))
    joined = lookup_join(rows.select("doc_id", "uid"), keep(sums.join(gone, "uid", "left"), "sums"),
                         "uid", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select("doc_id", *(F.coalesce(c, zero).alias(c) for c in ("n_lines", "n_removed", "n_links")),
                         "class_id")
