"""Repeated substrings: every byte under a string of n bytes that starts twice.

A corpus has no one place for a suffix array, so it is cut by content. The
anchor of a string of n bytes is its 64-byte part with the least hash, the
leftmost of equals: it hangs on the string alone, so equal strings have equal
anchors at equal places. Starts that share an anchor follow each other; the
bytes under them are that anchor's context. A string can only start twice in
contexts of one anchor hash. Equal contexts are settled by counting. Where one
anchor has different contexts, a task sorts their suffixes, takes the
Burrows-Wheeler transform and extends intervals backwards, breadth first, which
gives common prefixes by increasing length, up to n: borders never reached
part suffixes with n bytes in common. An anchor with very many contexts is
settled by counting the hashes of its strings instead, in as many tasks as
there are.

Defined cases: a null text is empty; texts shorter than n have nothing to
remove; rows that repeat repeat all their strings; an empty table gives no
rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..sources.scratch import keep

LENGTH = 400
GRAM = 64
MANY_CONTEXTS = 2000  # of one anchor: beyond, strings are counted by hash
_SPAN = 1 << 18  # bytes worked on at once; their places fit 24 bits
_TEXTS = 256
_SORT_BYTES = 1 << 19  # of contexts sorted at once, but for a larger anchor
_MIX = np.uint64(0x9E3779B97F4A7C15)
# Bytes that are in no UTF-8 text: one after each text, one at the very end,
# which makes the transform that of a ring.
_STOP, _END = b"\xff", b"\xfe"

ANCHORS = "uid BIGINT, low BIGINT, high BIGINT, anchor BIGINT, k1 BIGINT, k2 BIGINT"


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from each place, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    base, width = 0xD6E8FEB86659FD93, 1
    while width < gram:
        h = h[:-width] * np.uint64(base) + h[width:]
        base = base * base % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, from two running minima."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1:n])


def anchors_of(data: np.ndarray, length: int, gram: int) -> tuple:
    """(low, high, hash): starts low..high - 1 share an anchor with that hash."""
    h = gram_hashes(data, gram)
    place = np.arange(len(h), dtype=np.uint64)
    key = (h >> np.uint64(24) << np.uint64(24)) | place
    least = _sliding_min(key, length - gram + 1) & np.uint64((1 << 24) - 1)
    turns = np.flatnonzero(np.diff(least)) + 1
    low = np.concatenate([[0], turns])
    high = np.concatenate([turns, [len(least)]])
    return low, high, h[least[low].astype(np.int64)]


def context_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(uid, low, high, anchor, k1, k2): one row per context, k1 and k2 its hash."""
    def found(batches):
        # A few hundred texts at once: a batch may hold thousands.
        for batch in (b.slice(at, _TEXTS) for b in batches for at in range(0, b.num_rows, _TEXTS)):
            rows = {name: [] for name in ("uid", "low", "high", "anchor", "k1", "k2")}
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text")):
                raw = (text.as_py() or "").encode()
                # Starts are shared out among parts; bytes under them overlap.
                for at in range(0, len(raw) - length + 1, _SPAN):
                    part = raw[at:at + _SPAN + length - 1]
                    if len(part) < length:
                        continue
                    low, high, h = anchors_of(np.frombuffer(part, dtype=np.uint8), length, gram)
                    digest = xxhash.xxh3_128_digest
                    keys = b"".join(digest(part[a:b + length - 1])
                                    for a, b in zip(low.tolist(), high.tolist()))
                    both = np.frombuffer(keys, dtype=np.int64).reshape(-1, 2)
                    rows["uid"].append(np.full(len(low), uid))
                    rows["low"].append(low + at)
                    rows["high"].append(high + at)
                    rows["anchor"].append(h.view(np.int64))
                    rows["k1"].append(both[:, 0])
                    rows["k2"].append(both[:, 1])
            if rows["uid"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in rows.values()], names=list(rows))

    return docs.mapInArrow(found, ANCHORS)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   many: int = MANY_CONTEXTS) -> DataFrame:
    """(uid, low, high): bytes low..high - 1 to remove; spans may overlap.

    ``docs`` hold uid, equal for equal texts only, and text.
    """
    anchors = keep(context_anchors(docs, length, gram), "anchors")
    classes = anchors.groupBy("k1", "k2").agg(
        F.count("*").alias("n"), F.min("anchor").alias("anchor"),
        F.min(F.struct("uid", "low", "high")).alias("first"))
    classes = keep(classes.select("k1", "k2", "n", "anchor", "first.*"), "classes")

    copies = classes.where("n > 1")
    exact = _among(anchors, copies).select("uid", "low", (F.col("high") + length - 1).alias("high"))

    crowds = classes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = keep(lookup_join(classes, keep(crowds, "crowds"), "anchor"), "mixed")
    # A context in two numbers, as lists of these are broadcast: where it lies, and its anchor.
    unit = 4 * (length + 1)
    place = (F.col("low") * unit + (F.col("high") - F.col("low")) * 4
             + F.when(F.col("n") > 1, 2).otherwise(0) + F.when(F.col("kinds") > many, 1).otherwise(0))
    wanted = mixed.groupBy("uid").agg(F.collect_list(F.struct(place.alias("place"), "anchor")).alias("wanted"))
    wanted = wanted.select("uid", F.col("wanted.place").alias("places"), F.col("wanted.anchor").alias("anchors"))
    # A text that repeats is read once for each row; its contexts count once.
    texts = lookup_join(docs.select("uid", "text"), keep(wanted, "wanted"), "uid")
    low, starts = (F.expr(x) for x in (f"w.places div {unit}", f"w.places % {unit} div 4"))
    cut = F.substring(F.col("text").cast("binary"), (low + 1).cast("int"), (starts + length - 1).cast("int"))
    contexts = texts.withColumn("w", F.explode(F.arrays_zip("places", "anchors"))).select(
        "uid", low.alias("low"), F.col("w.anchors").alias("anchor"), F.expr("w.places % 4 >= 2").alias("again"),
        F.expr("w.places % 2 = 1").alias("crowded"), cut.alias("bytes"))

    def sort(batches):
        # Anchors before the last one, and the contexts of the last one.
        held, size, own, own_size = [], 0, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("uid", "low", "anchor", "again", "bytes")]
            for at in range(batch.num_rows):
                row = tuple(column[at].as_py() for column in columns)
                if own and row[2] != own[-1][2]:
                    held, size, own, own_size = held + own, size + own_size, [], 0
                own.append(row)
                own_size += len(row[4])
                if held and size + own_size > _SORT_BYTES:
                    yield _spans_batch(held, length)
                    held, size = [], 0
        if held or own:
            yield _spans_batch(held + own, length)

    few = contexts.where("NOT crowded").repartition("anchor").sortWithinPartitions("anchor")
    sorted_out = few.mapInArrow(sort, "uid BIGINT, low BIGINT, high BIGINT")

    def strings(batches):
        for batch in batches:
            for uid, low, data in zip(*(batch.column(c).to_pylist() for c in ("uid", "low", "bytes"))):
                n = len(data) - length + 1
                keys = b"".join(xxhash.xxh3_128_digest(data[i:i + length]) for i in range(n))
                both = np.frombuffer(keys, dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, uid)), pa.array(np.arange(n) + low),
                     pa.array(both[:, 0]), pa.array(both[:, 1])], names=["uid", "low", "k1", "k2"])

    crowded = contexts.where("crowded").select("uid", "low", "bytes")
    counted = crowded.mapInArrow(strings, "uid BIGINT, low BIGINT, k1 BIGINT, k2 BIGINT").distinct()
    several = counted.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1")
    hashed = _among(counted, several).select("uid", "low", (F.col("low") + length).alias("high"))
    return exact.unionByName(sorted_out).unionByName(hashed)


def _among(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose (k1, k2) is among the distinct ones of ``pairs``, n telling how many rows have them.

    The pairs are joined salted: a passage may stand in most of the documents.
    """
    both = F.struct("k1", "k2").alias("both")
    counts = pairs.select(both, F.col("n").alias("_rows"))
    return lookup_join(rows.withColumn("both", both), counts.select("both"), "both", small=False, counts=counts)


def _spans_batch(held: list, length: int):
    uid, low, high = [], [], []
    marks = repeated_starts([h[4] for h in held], length)
    for (doc, at, _, again, data), starts in zip(held, marks):
        if again:  # settled by counting
            continue
        cuts = np.flatnonzero(np.diff(starts) > 1)
        for a, b in zip(np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(starts) - 1]])):
            if len(starts):
                uid.append(doc)
                low.append(at + int(starts[a]))
                high.append(at + int(starts[b]) + length)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (uid, low, high)],
                                      names=["uid", "low", "high"])


def repeated_starts(texts: list, length: int) -> list:
    """For each text the starts of strings of ``length`` bytes that start anywhere else too."""
    data = np.frombuffer(_STOP.join(texts) + _END, dtype=np.uint8)
    order = suffix_order(data, length)
    long = long_prefixes(data, order, length)
    again = np.zeros(len(data) + 1, dtype=bool)
    again[order] = long[:-1] | long[1:]
    out, at = [], 0
    for text in texts:
        out.append(np.flatnonzero(again[at:at + max(0, len(text) - length + 1)]))
        at += len(text) + 1
    return out


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts sorted by what follows, at least to ``depth`` bytes, by doubling."""
    n = len(data)
    key = _first_bytes(data)
    width = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        del key
        order = order.astype(np.int32)
        new = np.concatenate([[False], ordered[1:] != ordered[:-1]])
        del ordered
        rank = np.empty(n, dtype=np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32)
        if width >= depth + 1 or rank[order[-1]] == n - 1:
            return order
        del order, new
        key = rank.astype(np.uint64) * np.uint64(n + 1)
        key[:n - width] += rank[width:].astype(np.uint64) + np.uint64(1)
        width *= 2


def _first_bytes(data: np.ndarray) -> np.ndarray:
    """Numbers that are in the order of the first seven bytes from each place."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    key = np.zeros(n, dtype=np.uint64)
    for i in range(7):
        key <<= np.uint64(8)
        key |= padded[i:n + i]
    key <<= np.uint64(3)
    key |= np.uint64(7)
    ends = np.arange(min(n, 7), 0, -1, dtype=np.uint64)  # an end comes before a zero byte
    key[n - len(ends):] = key[n - len(ends):] & ~np.uint64(7) | ends
    return key


def long_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes on both sides of each border share ``length`` bytes.

    Borders lie before, between and after the sorted suffixes. A border is met
    at the level of its common prefix: level l extends the intervals of strings
    of l bytes by a byte to the left; the last row of an interval with a given
    byte before it leads to the last row of the longer string's interval.
    """
    n = len(order)
    before = data[order - 1]  # the transform; the text is a ring
    by_byte = np.argsort(before, kind="stable").astype(np.int32)
    follow = np.empty(n, dtype=np.int32)  # the row of the suffix that is one byte longer
    follow[by_byte] = np.arange(n, dtype=np.int32)
    # The next row with the same byte before it; n if there is none.
    same = before[by_byte[1:]] == before[by_byte[:-1]]
    following = np.full(n, n, dtype=np.int32)
    following[by_byte[:-1][same]] = by_byte[1:][same]
    previous = np.full(n, -1, dtype=np.int32)
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    del before, by_byte, same
    met = np.zeros(n + 1, dtype=bool)
    met[0] = met[n] = True
    low, high = np.array([0], dtype=np.int32), np.array([n], dtype=np.int32)
    for _ in range(length):
        sizes = high - low
        at = np.cumsum(sizes, dtype=np.int32)
        rows = np.arange(at[-1], dtype=np.int32) + np.repeat(low - at + sizes, sizes)
        # Intervals of one level are disjoint, so both kinds of ends pair up in order.
        first = rows[previous[rows] < np.repeat(low, sizes)]
        last = rows[following[rows] >= np.repeat(high, sizes)]
        low, high = np.sort(follow[first]), np.sort(follow[last]) + np.int32(1)
        fresh = ~met[high]
        low, high = low[fresh], high[fresh]
        met[high] = True
        if not len(low):
            break
    return ~met


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                    many: int = MANY_CONTEXTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per document; kept is what is left, as bytes."""
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("uid"))
    spans = repeated_spans(rows.select("uid", "text"), length, gram, many)
    spans = spans.groupBy("uid").agg(F.collect_set(F.struct("low", "high")).alias("spans"))

    def merge(batches):
        for batch in batches:
            runs = [[{"low": a, "high": b} for a, b in _merged(x.values)] for x in batch.column("spans")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array(runs, batch.schema.field("spans").type)], names=["uid", "spans"])

    spans = keep(spans.mapInArrow(merge, spans.schema), "spans")
    marked = lookup_join(rows, spans, "uid", "left")
    # Texts stay where they were read. Bytes are put together as Latin-1, where each one is a character.
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    start = F.array(F.lit(0).cast("bigint"))
    end = F.array(F.octet_length("text").cast("bigint"))
    parts = F.zip_with(F.concat(start, "spans.high"), F.concat("spans.low", end), lambda a, b: F.decode(
        F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")), "ISO-8859-1"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + x.high - x.low)
    return marked.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.array_size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.when(F.col("spans").isNull(), raw).otherwise(
            F.encode(F.array_join(parts, ""), "ISO-8859-1")).alias("kept"))


def _merged(spans) -> list:
    """Maximal runs of bytes under any of the spans."""
    low, high = (spans.field(c).to_numpy() for c in ("low", "high"))
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate([[True], low[1:] > high[:-1]])
    return list(zip(low[new].tolist(), high[np.append(new[1:], True)].tolist()))
