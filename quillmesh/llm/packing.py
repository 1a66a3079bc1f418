"""Pack tokenised documents into sequences by linear grouping.

Lengths are at most the capacity, so a histogram of them is a bounded summary
of any corpus. From it alone the driver plans patterns (lengths that share a
sequence, and how many sequences look so): large lengths are cut into groups
of equally many pieces and rounded up to the greatest of their group; a small
linear programme picks configurations of rounded lengths; real lengths take the
places; what is left over and all small pieces go where they fit best. Pieces
then find their places by their rank among those of the same length.

Defined cases: a null text is taken as empty and gives the one end token;
repeated rows are packed as often as they come; an empty table gives no rows.
Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep
from .common import before

CAPACITY = 1024
END = 2
TOKENIZER = "byte_bpe_50k"
GROUPS = 128
_RANK_BUCKETS = 256
_SPECIAL = "<|endoftext|>"
_LONG_RUN = 2000  # characters without a break that the plain tokenizer takes better

PIECES = "doc_id {id}, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"


class Encoder:
    """Token ids of a text, as the tokenizer file gives them.

    The rank file holds the same vocabulary for a faster library. Texts with
    the string of a special token, or with very long runs, go to the other.
    """

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        import tiktoken

        self._file = public_tokenizers.path(f"{name}.json")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._plain = None

    def __call__(self, text: str) -> list:
        if _SPECIAL not in text and (len(text) < _LONG_RUN or not _has_long_run(text)):
            return self._fast.encode_ordinary(text)
        if self._plain is None:
            from tokenizers import Tokenizer

            self._plain = Tokenizer.from_file(self._file)
        return self._plain.encode(text, add_special_tokens=False).ids


def _has_long_run(text: str) -> bool:
    if max(map(len, text.split()), default=0) >= _LONG_RUN:
        return True
    return " " * 64 in text or "\n" * 64 in text


def document_pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END,
                    tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of tokenised documents.

    A document longer than the capacity is cut into full pieces; the first is
    the shorter one.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = PIECES.format(id=id_type)

    def pieces(batches):
        encode = Encoder(tokenizer)
        for batch in batches:
            rows, piece, start, length, crc = (array(kind) for kind in "qiqqq")
            for row, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "")
                ids.append(end)
                data = np.array(ids, dtype="<u4").tobytes()
                n = len(ids)
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a:4 * b]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(np.array(rows))),
                    pa.array(np.array(piece), pa.int32()),
                    *(pa.array(np.array(x), pa.int64()) for x in (start, length, crc)),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    pieces = keep(document_pieces(docs, capacity, **options), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, used, first = [], {}, 0
    for lengths, times in packing_plan(counts, capacity, groups):
        offset = 0
        for length in lengths:
            low = used.get(length, 0)
            slots.append((length, low, low + times, first, offset))
            used[length] = low + times
            offset += length
        first += times
    places = docs.sparkSession.createDataFrame(
        slots, "length BIGINT, low BIGINT, high BIGINT, first BIGINT, offset BIGINT")
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(_RANK_BUCKETS))
    ranked = before(pieces, ["length"], bucket, ["doc_id", "piece", "start", "ids_crc32"],
                    F.lit(1), "rank")
    # The plan is bounded by the capacity, not by the corpus.
    return (
        ranked.join(F.broadcast(places), "length")
        .where("rank >= low AND rank < high")
        .select("doc_id", "piece", "start", "length", "ids_crc32",
                (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")
    )


def packing_plan(counts: dict, capacity: int, groups: int = GROUPS) -> list:
    """[(lengths, times)]: patterns that use up a histogram of lengths."""
    small = capacity // 4  # no more than three larger ones share a sequence
    large = sorted((x for x in counts.items() if small < x[0] < capacity), reverse=True)
    bins = _Bins(capacity)
    if counts.get(capacity):
        bins.add((capacity,), counts[capacity])
    rest = {length: n for length, n in counts.items() if length <= small}
    runs = _equal_groups(large, groups)
    sizes = [run[0][0] for run in runs]
    for members, times in _configurations(sizes, [sum(n for _, n in r) for r in runs], capacity):
        _substitute(bins, runs, members, times)
    for run in runs:
        for length, n in run:
            rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        bins.best_fit(length, rest[length])
    return bins.patterns()


def _equal_groups(large: list, groups: int) -> list:
    """Runs of (length, n), longest first, cut into groups of equally many."""
    each = -(-sum(n for _, n in large) // groups)
    out, room = [], 0
    for length, n in large:
        while n:
            if not room:
                out.append([])
                room = each
            k = min(n, room)
            out[-1].append((length, k))
            n, room = n - k, room - k
    return out


def _configurations(sizes: list, supply: list, capacity: int) -> list:
    """[(groups, times)] of rounded lengths: the whole part of the best mix.

    Minimises the number of sequences over all sets of up to three rounded
    lengths that fit, by the simplex method with one row per group.
    """
    g = len(sizes)
    if not g:
        return []
    # Index g is an empty place.
    size = np.array([*sizes, 0])
    a, b = np.triu_indices(g + 1)
    two = size[a] + size[b] <= capacity
    a, b = a[two], b[two]
    left = capacity - size[a] - size[b]
    third = np.searchsorted(-size, -left)  # the first, so largest, that fits
    third = np.maximum(third, b)
    n = g + 1 - third
    rows = np.repeat(np.arange(len(a)), n)
    c = third[rows] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    sets = np.stack([a[rows], b[rows], c], axis=1)
    sets = sets[sets[:, 0] < g]

    need = np.array(supply, dtype=float)
    basis = np.stack([np.arange(g), np.full(g, g), np.full(g, g)], axis=1)
    inverse, x = np.eye(g), need.copy()
    for _ in range(50 * g):
        price = np.append(inverse.sum(axis=0), 0.0)
        worth = price[sets[:, 0]] + price[sets[:, 1]] + price[sets[:, 2]]
        best = int(worth.argmax())
        if worth[best] <= 1 + 1e-9:
            break
        column = np.bincount(sets[best], minlength=g + 1)[:g].astype(float)
        step = inverse @ column
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1.0), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        x = x - ratio[out] * step
        x[out] = ratio[out]
        inverse[out] /= step[out]
        others = np.arange(g) != out
        inverse[others] -= np.outer(step[others], inverse[out])
        basis[out] = sets[best]
    return [([int(i) for i in s if i < g], int(t + 1e-6)) for s, t in zip(basis, x) if t >= 1]


def _substitute(bins: _Bins, runs: list, members: list, times: int) -> None:
    """Put real lengths, longest first, into ``times`` copies of a configuration."""
    while times:
        heads = {}
        for i in members:
            heads[i] = heads.get(i, 0) + 1
        if any(not runs[i] for i in heads):
            return
        k = min(times, *(runs[i][0][1] // m for i, m in heads.items()))
        if k:
            bins.add(tuple(runs[i][0][0] for i in members), k)
            for i, m in heads.items():
                length, n = runs[i][0]
                runs[i][0] = (length, n - k * m)
        else:  # a run too short for one copy: take its lengths one by one
            if any(sum(n for _, n in runs[i]) < m for i, m in heads.items()):
                return
            k = 1
            lengths = []
            for i in members:
                length, n = runs[i][0]
                lengths.append(length)
                runs[i][0] = (length, n - 1)
                if n == 1:
                    runs[i].pop(0)
            bins.add(tuple(lengths), 1)
        for i in heads:
            if runs[i] and not runs[i][0][1]:
                runs[i].pop(0)
        times -= k


class _Bins:
    """Sequences under way, those alike kept as one entry with a count."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: dict = {}
        self.rooms: list = []

    def add(self, lengths: tuple, times: int) -> None:
        room = self.capacity - sum(lengths)
        held = self.by_room.setdefault(room, {})
        if not held:
            insort(self.rooms, room)
        held[lengths] = held.get(lengths, 0) + times

    def best_fit(self, length: int, n: int) -> None:
        while n:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                fit = self.capacity // length
                if n >= fit:
                    self.add((length,) * fit, n // fit)
                if n % fit:
                    self.add((length,) * (n % fit), 1)
                return
            room = self.rooms[at]
            held = self.by_room[room]
            lengths, times = held.popitem()
            if not held:
                self.rooms.pop(at)
            k = min(n, times)
            if times > k:
                self.add(lengths, times - k)
            self.add((*lengths, length), k)
            n -= k

    def patterns(self) -> list:
        return [x for held in self.by_room.values() for x in held.items()]
