"""All-pairs sums over (id, label, x) samples, block by block.

Samples are packed into blocks and every two blocks meet in one row, where
numpy works out the kernel between them. Only sums leave a task - two
numbers per sample, or one d x d matrix - never the pairs. Where samples
lie so far apart that kernels are exactly 0, blocks are cut by balls, and those
that are out of each other's reach never meet.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import divide_or_zero
from .balls import KERNEL_REACH, Balls, balls_of, groups_of, meeting_groups, widest
from .pairs import PACKED, packed_batch, summed_matrices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BLOCK = 2048
MIN_BLOCK = 64
BLOCK_BYTES = 8 << 20
STRIP = 64  # rows of a block whose kernels are held at once
SCREEN = 256  # rows of a block whose rounded squares are held at once
DIFFERENCES = 1 << 20  # numbers in the differences of vectors that are held at once
KEPT_BLOCKS = 64  # blocks whose sums or nearest a task holds
ZERO_FROM = -750.0  # exp is exactly 0.0 in doubles up to here
# numpy has its own exp of doubles for AVX-512; elsewhere it takes the slower one of the C library.
SLOW_EXP = not any(kind["current"].startswith("AVX512") for found in np.lib.introspect.opt_func_info(
    func_name="^exp$", signature="float64").values() for kind in found.values())


def labelled_samples(samples: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """(id, label, x) rows, their number and dimension.

    Raises ValueError for a sample without a label, a repeated id or vectors
    of unequal length; one aggregate over the ids finds all three.
    """
    joined = samples.select("id", "x").join(labels.select("id", "label"), "id", "left")
    per_id = joined.groupBy("id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("label").isNull()).alias("bare"),
        F.min(F.size("x")).alias("low"),
        F.max(F.size("x")).alias("high"),
    )
    seen = per_id.agg(
        F.count("*").alias("n"), F.sum("bare").alias("bare"), F.max("n").alias("most"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    ).first()
    if not seen.n:
        raise ValueError("there are no samples")
    if seen.bare:
        raise ValueError(f"{seen.bare} samples have no label")
    if seen.most > 1:
        raise ValueError("sample or label ids repeat")
    if seen.low != seen.high:
        raise ValueError(f"vectors differ in length: {seen.low} to {seen.high}")
    return joined, seen.n, seen.low


def block_count(samples: DataFrame, n: int, d: int) -> int:
    """Blocks of about MAX_BLOCK samples or BLOCK_BYTES, and enough to fill the cores."""
    cores = samples.sparkSession.sparkContext.defaultParallelism
    most = max(1, min(MAX_BLOCK, BLOCK_BYTES // (8 * d)))
    return math.ceil(n / min(most, max(MIN_BLOCK, math.ceil(n / (2 * cores)))))


def block_cells(samples: DataFrame, blocks: int) -> DataFrame:
    """(own, own_x, other, other_x, diagonal) rows, one for every two blocks.

    Blocks are dealt to groups and every two groups meet in one cell, where
    their blocks do. A block travels once or twice per group, and groups grow
    with the root of the tasks, not with the samples. Cells are merged, so the
    blocks of a group may spill.
    """
    groups = group_count(blocks, _cell_tasks(samples, blocks))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    packed = _with_bytes(samples.groupBy(block).agg(_rows(samples)))
    group = F.col("block") % groups
    own = packed.select(
        group.alias("low"), F.explode(F.sequence(group, F.lit(groups - 1))).alias("high"),
        F.col("block").alias("own_block"), F.col("rows").alias("own"), F.col("x").alias("own_x"),
    )
    other = packed.select(
        F.explode(F.sequence(F.lit(0), group)).alias("low"), group.alias("high"),
        F.col("block").alias("other_block"), F.col("rows").alias("other"), F.col("x").alias("other_x"),
    )
    own, other = _dealt(own, other, groups * (groups + 1) // 2)
    return (
        own.join(other.hint("merge"), ["low", "high"])
        .where("low < high or own_block <= other_block")
        .select("own", "own_x", "other", "other_x", (F.col("own_block") == F.col("other_block")).alias("diagonal"))
    )


def kernel_balls(samples: DataFrame, matrix, blocks: int) -> Balls | None:
    """Balls to cut the samples by, or None where no kernel can be 0 for distance."""
    if widest(samples, matrix) <= KERNEL_REACH:
        return None
    return balls_of(samples, matrix, max(2, blocks))


def ball_cells(samples: DataFrame, blocks: int, balls: Balls) -> DataFrame:
    """As ``block_cells``, with blocks cut by balls; only what is within reach meets.

    A ball with many samples makes several blocks. Groups are balls next to each
    other, and a block travels only to the groups that hold a ball near its own.
    """
    near = balls.within(KERNEL_REACH)
    of_ball = groups_of(balls.counts, group_count(blocks, _cell_tasks(samples, blocks)))
    met = meeting_groups(near, of_ball, of_ball)
    packed = _with_bytes(_packed(balls, samples, blocks))
    both = np.triu(met | met.T)
    own = _sent(packed, near, of_ball, both, "low", "high").select(
        "low", "high", F.col("block").alias("own_block"), F.col("ball").alias("own_ball"), "near",
        F.col("rows").alias("own"), F.col("x").alias("own_x"))
    other = _sent(packed, near, of_ball, both.T, "high", "low").select(
        "low", "high", F.col("block").alias("other_block"), F.col("ball").alias("other_ball"),
        F.col("rows").alias("other"), F.col("x").alias("other_x"))
    own, other = _dealt(own, other, int(both.sum()))
    return (
        own.join(other.hint("merge"), ["low", "high"])
        .where("array_contains(near, other_ball)")
        .where("low < high or (own_ball, own_block) <= (other_ball, other_block)")
        .select("own", "own_x", "other", "other_x",
                F.expr("own_ball = other_ball and own_block = other_block").alias("diagonal"))
    )


def _rows(samples: DataFrame):
    """A block of samples, by id: a block is the same in each copy."""
    return F.sort_array(F.collect_list(F.struct(*samples.columns))).alias("rows")


def _with_bytes(packed: DataFrame) -> DataFrame:
    """Blocks with their vectors as x, a binary, which travels as one value; all else stays in rows."""
    others = [c for c in packed.columns if c != "rows"]
    names = [c for c in packed.schema["rows"].dataType.elementType.names if c != "x"]
    cut = packed.select(*others, F.transform("rows", lambda r: F.struct(*(r[c].alias(c) for c in names))).alias("rows"),
                        F.col("rows.x").alias("x"))
    schema = cut.withColumn("x", F.lit(b"")).schema

    def binary(batches):
        for batch in batches:
            x = pa.array([_bytes(vectors.values) for vectors in batch.column("x")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], x], names=schema.names)

    return cut.mapInArrow(binary, schema)


def _bytes(vectors) -> bytes:
    """Vectors as floats if that loses nothing, or else as doubles."""
    if vectors.null_count or vectors.flatten().null_count:
        raise ValueError("a vector or one of its components is null")
    x = vectors.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return (short if np.array_equal(short, x) else x).tobytes()


def _dealt(own: DataFrame, other: DataFrame, cells: int) -> tuple[DataFrame, DataFrame]:
    """Both sides by cell, if partitions allow to so many tasks that few have more than one."""
    tasks = max(1, min(2 * cells, _tasks(own)))
    return tuple(side.repartition(tasks, "low", "high") for side in (own, other))


def _packed(balls: Balls, samples: DataFrame, blocks: int) -> DataFrame:
    """(ball, block, rows): the samples of a ball in blocks of the usual size."""
    size = max(1, math.ceil(int(balls.counts.sum()) / blocks))
    parts = F.lit([max(1, math.ceil(n / size)) for n in balls.counts.tolist()])
    part = F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("ball") + 1)).cast("int")
    return balls.place(samples).groupBy("ball", part.alias("block")).agg(_rows(samples))


def _sent(packed: DataFrame, near: np.ndarray, of_ball: np.ndarray, met: np.ndarray,
          own: str, other: str) -> DataFrame:
    """Blocks copied to all the groups that their own group meets, with the balls near theirs."""
    known = [(ball, int(of_ball[ball]), met[of_ball[ball]].nonzero()[0].tolist(), near[ball].nonzero()[0].tolist())
             for ball in range(len(of_ball))]
    known = packed.sparkSession.createDataFrame(
        known, f"ball INT, {own} INT, others ARRAY<INT>, near ARRAY<INT>")
    # A row per ball, of which there are MAX_PIVOTS at most.
    return packed.join(F.broadcast(known), "ball").withColumn(other, F.explode("others"))


def _tasks(samples: DataFrame) -> int:
    session = samples.sparkSession
    return max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)


def _cell_tasks(samples: DataFrame, blocks: int) -> int:
    """Tasks to cut all pairs for: more would copy blocks oftener and end no sooner, fewer hold longer groups."""
    cores = samples.sparkSession.sparkContext.defaultParallelism
    return min(_tasks(samples), max(4 * cores, blocks // 16))


def _cells_of(samples: DataFrame, blocks: int, balls: Balls | None) -> DataFrame:
    return block_cells(samples, blocks) if balls is None else ball_cells(samples, blocks, balls)


def group_count(blocks: int, tasks: int) -> int:
    """Groups of blocks for about two cells per task."""
    return min(blocks, math.ceil(2 * math.sqrt(tasks)))


def kernel_sums(samples: DataFrame, matrix, blocks: int, balls: Balls | None = None) -> DataFrame:
    """(id, z, s): kernel sums of each sample over all others and its own label."""
    a = samples.sparkSession.sparkContext.broadcast(np.asarray(matrix, dtype=float))
    schema = samples.select("id", F.lit(0.0).alias("z"), F.lit(0.0).alias("s")).schema

    def sums(batches):
        kept = {}
        for own, other, diagonal in _cells(batches, a.value.shape[1]):
            rows, columns = _cell_sums(own, other, a.value, diagonal)
            for block, found in ((own, rows),) if diagonal else ((own, rows), (other, columns)):
                name = block["id"][0].as_py()  # of no other block
                if name in kept:
                    kept[name][1] += found
                else:
                    kept[name] = [block["id"], found]
            if len(kept) > KEPT_BLOCKS:
                yield from (_sums_batch(ids, *found) for ids, found in kept.values())
                kept = {}
        yield from (_sums_batch(ids, *found) for ids, found in kept.values())

    parts = _cells_of(samples.select("id", "label", "x"), blocks, balls).mapInArrow(sums, schema)
    return parts.groupBy("id").agg(F.sum("z").alias("z"), F.sum("s").alias("s"))


def success(sums: DataFrame) -> DataFrame:
    """(id, p, z): p is the chance of picking a neighbour of the own label."""
    return sums.select("id", divide_or_zero(F.col("s"), F.col("z")).alias("p"), "z")


def gradient(samples: DataFrame, successes: DataFrame, matrix, blocks: int,
             balls: Balls | None = None) -> DataFrame:
    """(r, c, v) of A . sum over pairs of p_ij (p_i - [same label]) x_ij x_ij^T.

    Within a cell the sum of v_ij x_ij x_ij^T over i, j is
    X^T diag(V 1) X + Y^T diag(V^T 1) Y - X^T V Y - (X^T V Y)^T.
    """
    a = samples.sparkSession.sparkContext.broadcast(np.asarray(matrix, dtype=float))
    scored = samples.select("id", "label", "x").join(successes.select("id", "p", "z"), "id")

    def fold(batches):
        total = np.zeros((a.value.shape[1], a.value.shape[1]))
        for own, other, diagonal in _cells(batches, a.value.shape[1]):
            total += _cell_fold(own, other, a.value, diagonal)
        yield packed_batch(a.value @ total)

    parts = _cells_of(scored, blocks, balls).mapInArrow(fold, PACKED)
    return summed_matrices(parts, a.value.shape)


def nearest(samples: DataFrame, matrix, blocks: int, k: int, digits: int = 9) -> DataFrame:
    """(id, neighbour, label, distance) candidates: the k nearest of what a task compares.

    Distances are rounded; equal ones go by neighbour id. The k nearest of all
    samples are among them. A task keeps the k best of each sample of up to
    KEPT_BLOCKS blocks, so what it sends does not grow with the pairs of blocks.
    All pairs are compared, in single precision; those that may be among the k
    nearest by that are worked out in doubles.
    """
    a = samples.sparkSession.sparkContext.broadcast(np.asarray(matrix, dtype=float))
    schema = samples.select(
        "id", F.col("id").alias("neighbour"), "label", F.lit(0.0).alias("distance")
    ).schema

    def candidates(batches):
        kept = {}
        for own, other, diagonal in _cells(batches, a.value.shape[1]):
            first, second = (kept.setdefault(block["id"][0].as_py(), _Nearest(block, k))  # a name of no other block
                             for block in (own, other))
            _compare(first, own["x"] @ a.value.T, second, other["x"] @ a.value.T, digits)
            if len(kept) > KEPT_BLOCKS:
                yield from (block.best() for block in kept.values())
                kept = {}
        yield from (block.best() for block in kept.values())

    return block_cells(samples.select("id", "label", "x"), blocks).mapInArrow(candidates, schema)


def nearest_of(queries: DataFrame, samples: DataFrame, matrix, blocks: int, k: int, digits: int = 9) -> DataFrame:
    """(id, neighbour, label, distance) candidates among ``samples`` for each query.

    Queries and samples are cut by the same pivots. A block of queries meets the
    balls that may hold one of its k nearest only, by the bounds that the balls
    with k samples together set. A task keeps the k best of each query over all
    blocks of a cell, so a cell sends k rows for a query, however many samples.
    """
    balls = balls_of(samples.select("id", "x"), matrix, max(2, blocks))
    asking = balls.measured(queries.select("x"))
    near = asking.nearest_within(balls, k)
    tasks = _tasks(samples)
    groups = math.ceil(math.sqrt(tasks))
    rows, columns = groups_of(asking.counts, groups), groups_of(balls.counts, groups)
    met = meeting_groups(near, rows, columns)
    own = _sent(_packed(asking, queries.select("id", "x"), blocks), near, rows, met, "row", "column").select(
        "row", "column", F.struct("ball", "block").alias("asking"), "near", F.col("rows").alias("own"))
    other = _sent(_packed(balls, samples.select("id", "label", "x"), blocks), near.T, columns, met.T,
                  "column", "row").select("row", "column", F.col("ball").alias("other_ball"), F.col("rows").alias("other"))
    tasks = max(1, min(tasks, int(met.sum())))
    own, other = (side.repartition(tasks, "row", "column") for side in (own, other))
    cells = own.join(other.hint("merge"), ["row", "column"]).where("array_contains(near, other_ball)")
    cells = cells.select(F.struct("row", "column").alias("cell"), "asking", "own", "other")
    a = samples.sparkSession.sparkContext.broadcast(np.asarray(matrix, dtype=float))
    schema = queries.select("id").join(
        samples.select(F.col("id").alias("neighbour"), "label"), F.lit(False)).withColumn(
        "distance", F.lit(0.0)).schema

    def best(batches):
        cell, kept = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                if batch.column("cell")[at].as_py() != cell:
                    yield from kept.values()
                    cell, kept = batch.column("cell")[at].as_py(), {}
                name = tuple(batch.column("asking")[at].as_py().values())
                own, other = (_unpack(batch.column(c)[at].values) for c in ("own", "other"))
                d = np.round(np.sqrt(_squares(own["x"], other["x"], a.value)), digits)
                found = _nearest_batch(own, other, d, k, False)
                kept[name] = _best([kept[name], found], k) if name in kept else found
        yield from kept.values()

    return cells.mapInArrow(best, schema)


class _Nearest:
    """The k nearest found so far to each sample of a block, and bounds for what is yet to come."""

    def __init__(self, block: dict, k: int):
        self.ids, self.labels, self.k = block["id"], block["label"], k
        self.distances = np.full((len(self.ids), k), np.inf)
        self.found, self.held, self.ranked = [], 0, False

    @property
    def bounds(self) -> np.ndarray:
        """No neighbour further than this is among the k nearest."""
        return self.distances[:, -1]

    def add(self, rows: np.ndarray, other: _Nearest, columns: np.ndarray, distance: np.ndarray) -> None:
        """Samples in these columns of the other block are neighbours of those in these rows."""
        near = np.flatnonzero(~(distance > self.bounds[rows]))
        near = near[np.lexsort((distance[near], rows[near]))]
        rows, columns, distance = rows[near], columns[near], distance[near]
        if not len(rows):
            return
        starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
        touched, first = rows[starts], rank < self.k
        new = np.full((len(touched), self.k), np.inf)
        new[np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))[first], rank[first]] = distance[first]
        self.distances[touched] = np.sort(np.concatenate([self.distances[touched], new], axis=1), axis=1)[:, :self.k]
        near = ~(distance > self.bounds[rows])
        rows, columns = pa.array(rows[near]), pa.array(columns[near])
        self.found.append(pa.RecordBatch.from_arrays(
            [self.ids.take(rows), other.ids.take(columns), other.labels.take(columns), pa.array(distance[near])],
            names=["id", "neighbour", "label", "distance"]))
        self.held, self.ranked = self.held + len(rows), False
        if self.held > 8 * self.k * len(self.ids):
            self.best()

    def best(self):
        if not self.ranked:
            self.found = [_best(self.found, self.k)] if self.found else [_no_neighbours(self.ids, self.labels)]
            self.held, self.ranked = self.found[0].num_rows, True
        return self.found[0]


def _no_neighbours(ids, labels):
    none = pa.array([], pa.int64())
    return pa.RecordBatch.from_arrays([ids.take(none), ids.take(none), labels.take(none), pa.array([], pa.float64())],
                                      names=["id", "neighbour", "label", "distance"])


def _compare(own: _Nearest, x: np.ndarray, other: _Nearest, y: np.ndarray, digits: int) -> None:
    """Add the pairs of two blocks that may be among the k nearest of either sample.

    Squares of distances in single precision, with room for its rounding, tell which
    pairs may be; only the distances of those are worked out, from the differences.
    Where single precision leaves very many, doubles tell, and of samples with the same
    vector those with the smallest ids are compared.
    """
    diagonal = own is other
    usable = np.isfinite(x).all(axis=1)
    centre = x[usable].mean(axis=0) if usable.any() else 0.0
    rounded, room = _squares_of(x - centre, y - centre)
    slack, pairs = 10.0 ** -digits, max(1, DIFFERENCES // x.shape[1])
    rows_limit, columns_limit = (_limit(block.bounds, slack, room) for block in (own, other))
    first_few, new, held = None, bool(np.isinf(other.bounds).any()), []
    for at in range(0, len(x), SCREEN):
        rows = slice(at, min(at + SCREEN, len(x)))
        squares = rounded(rows)
        if diagonal:
            squares[np.arange(len(squares)), np.arange(rows.start, rows.stop)] = np.inf
        _tighten(rows_limit[rows], squares, own.k, slack, room)
        far = squares > rows_limit[rows, None]
        if not diagonal:
            _tighten(columns_limit, squares.T, own.k, slack, room)
            far &= squares > columns_limit[None, :]
        if diagonal:
            far[np.arange(len(far)), np.arange(rows.start, rows.stop)] = True
        near = np.flatnonzero(~far.ravel())
        if len(near) > far.size // 8 and len(near) > 1 << 12:
            if first_few is None:
                exact, exact_room = _squares_of(x - centre, y - centre, np.float64)
                first_few = _first_few(x, own.k + 1), _first_few(y, own.k + 1)
            squares = exact(rows)
            far |= (squares > _limit(own.bounds[rows], slack, exact_room, np.float64)[:, None]) & (
                diagonal | (squares > _limit(other.bounds, slack, exact_room, np.float64)[None, :]))
            needed = first_few[1][None, :] if diagonal else first_few[0][rows, None] | first_few[1][None, :]
            near = np.flatnonzero(~far.ravel() & np.broadcast_to(needed, far.shape).ravel())
        for part in np.split(near, range(pairs, len(near), pairs)):
            i, j = np.divmod(part, len(y))
            away = x[at + i] - y[j]
            held.append((at + i, j, np.round(np.sqrt(np.einsum("nd,nd->n", away, away)), digits)))
            if new or rows.stop == len(x) or sum(len(i) for i, _, _ in held) > pairs:
                i, j, away = (np.concatenate(c) for c in zip(*held))
                held = []
                own.add(i, other, j, away)
                if not diagonal:
                    other.add(j, own, i, away)
        if new and not diagonal:
            np.minimum(columns_limit, _limit(other.bounds, slack, room), out=columns_limit)


def _squares_of(x: np.ndarray, y: np.ndarray, dtype=np.float32) -> tuple:
    """A function that gives squared distances from some rows of x to all y, and how far they may be off."""
    of_x, of_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
    most = (math.sqrt(of_x.max()) + math.sqrt(of_y.max())) ** 2
    if not most < 1e30:
        dtype = np.float64
    left = np.column_stack([-2.0 * x, of_x, np.ones(len(x))]).astype(dtype)
    right = np.column_stack([y, np.ones(len(y)), of_y]).T.astype(dtype)
    # A sum of d + 2 products, each of numbers rounded once before.
    return lambda rows: left[rows] @ right, (x.shape[1] + 8) * float(np.finfo(dtype).eps) * most


def _limit(bounds: np.ndarray, slack: float, room: float, dtype=np.float32) -> np.ndarray:
    """Computed squares above this are of distances above the bounds, even if rounded."""
    with np.errstate(over="ignore"):
        return np.nextafter(((bounds + slack) ** 2 * (1 + 1e-9) + room).astype(dtype), dtype(np.inf))


def _tighten(limit: np.ndarray, squares: np.ndarray, k: int, slack: float, room: float) -> None:
    """Limits of rows without bounds, in place: the k-th of the least squares of several sets of columns is no less than the k-th of all."""
    if len(limit) == 0 or not np.isinf(limit).any():
        return
    sets = min(squares.shape[1], max(64, 4 * k))
    if sets < k:
        return
    each = squares.shape[1] // sets
    least = squares[:, :sets * each].reshape(len(squares), each, sets).min(axis=1)
    kth = np.maximum(np.partition(least, k - 1, axis=1)[:, k - 1].astype(float) + room, 0.0)
    np.minimum(limit, _limit(np.sqrt(kth), slack, room), out=limit)


def _first_few(x: np.ndarray, few: int) -> np.ndarray:
    """Whether a sample is one of the first few with its vector."""
    x = np.ascontiguousarray(x)
    _, same = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    order = np.argsort(same, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(same))])
    found = np.empty(len(x), dtype=bool)
    found[order] = np.arange(len(x)) - starts[same[order]] < few
    return found


def _best(batches: list, k: int):
    """Of the candidates of some batches the k nearest to each id; ties to the smaller neighbour."""
    both = pa.Table.from_batches(batches).combine_chunks()
    both = both.sort_by([("id", "ascending"), ("distance", "ascending"), ("neighbour", "ascending")])
    codes = both.column("id").combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.concatenate([[True], codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, dtype=bool)
    rank = np.arange(len(codes)) - np.maximum.accumulate(np.where(first, np.arange(len(codes)), 0))
    return both.filter(pa.array(rank < k)).to_batches()[0]


def _cells(batches, d: int):
    """The packed samples of each row as numpy columns; ids and labels as Arrow."""
    for batch in batches:
        for at in range(batch.num_rows):
            sides = (_block(batch.column(name)[at].values, batch.column(f"{name}_x")[at].as_buffer(), d)
                     for name in ("own", "other"))
            yield *sides, batch.column("diagonal")[at].as_py()


def _block(rows, data, d: int) -> dict:
    x = np.frombuffer(data, dtype=f"f{data.size // (len(rows) * d)}")
    return _unpack(rows) | {"x": x.reshape(len(rows), d).astype(float)}


def _unpack(rows) -> dict:
    columns = {}
    for field in rows.type:
        column = rows.field(field.name)
        if field.name == "x":
            if column.null_count or column.flatten().null_count:
                raise ValueError("a vector or one of its components is null")
            column = column.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        elif field.name in ("p", "z"):
            column = column.to_numpy(zero_copy_only=False)
        columns[field.name] = column
    return columns


def _squares(x: np.ndarray, y: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Squared distances between rows of x and y under a."""
    centre = x.mean(axis=0)
    x, y = (x - centre) @ a.T, (y - centre) @ a.T
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.maximum(squares, 0.0)


def _strips(own: dict, other: dict, a: np.ndarray, diagonal: bool):
    """(rows, kernels, parts, room) between STRIP rows of own at a time and all of other, both sorted by code.

    Parts are the rows and columns of the kernels that have one label. Rows whose
    kernels are all 0 are left out. The kernels are overwritten by the next ones;
    the room is as large as they are, for the caller to use.
    """
    centre = own["x"].mean(axis=0)
    x, y = (own["x"] - centre) @ a.T, (other["x"] - centre) @ a.T
    of_x, of_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
    furthest = (math.sqrt(of_x.max()) + math.sqrt(of_y.max())) ** 2
    wide = not furthest < -ZERO_FROM
    halvings = _halvings(-ZERO_FROM if wide else furthest)
    scale = 1.0 if wide or not SLOW_EXP else _exp_scale(halvings)
    # -|x - y|^2 in one product.
    left = np.column_stack([2.0 * scale * x, -scale * of_x, np.full(len(x), -scale)])
    right = np.column_stack([y, np.ones(len(y)), of_y]).T
    room = np.empty((3, min(STRIP, len(x)), len(y)))
    for at in range(0, len(x), STRIP):
        rows = slice(at, min(at + STRIP, len(x)))
        k, *spare = room[:, :rows.stop - at]
        np.matmul(left[rows], right, out=k)
        if wide:
            near = np.flatnonzero(~(k <= ZERO_FROM))
            if not len(near):
                continue
        if wide and len(near) < k.size // 8:
            found = np.exp(np.minimum(k.ravel()[near], 0.0))
            k[:] = 0.0
            k.ravel()[near] = found
        else:
            if wide:
                np.clip(k, ZERO_FROM, 0.0, out=k)
            if SLOW_EXP:
                if wide:
                    k *= _exp_scale(halvings)
                _exp(k, halvings, *spare)
            else:
                np.exp(k, out=k)
        if diagonal:
            k[np.arange(len(k)), np.arange(at, at + len(k))] = 0.0
        yield rows, k, _parts(own["code"][rows], other["code"]), spare[0]


def _halvings(furthest: float) -> int:
    """How often to halve exponents of up to this size for _exp."""
    return max(0, math.ceil(math.log2(max(furthest, 1e-300) / 0.125)))


def _exp_scale(halvings: int) -> float:
    return 0.05 * 0.5 ** halvings


def _exp(t: np.ndarray, halvings: int, w: np.ndarray, e: np.ndarray) -> None:
    """exp(t / _exp_scale(halvings)) in place, to about 2^halvings roundings; w and e are overwritten.

    The quotient of two polynomials of degree 4 is exp to the last digit up to 0.125,
    and squares undo the halvings: a third of the time of the C library's exp.
    """
    np.multiply(t, t, out=w)
    np.add(w, 0.45, out=e)
    e *= w
    e += 0.0105
    w += 0.105
    w *= t
    np.add(e, w, out=t)
    e -= w
    t /= e
    for _ in range(halvings):
        np.multiply(t, t, out=t)


def _parts(rows: np.ndarray, columns: np.ndarray) -> list:
    """Slices of two sorted lists of codes that hold one code."""
    starts = np.concatenate([[0], np.flatnonzero(rows[1:] != rows[:-1]) + 1, [len(rows)]])
    codes = rows[starts[:-1]]
    low, high = (np.searchsorted(columns, codes, side) for side in ("left", "right"))
    return [(slice(*r), slice(*c)) for *r, c in zip(starts[:-1], starts[1:], zip(low, high)) if c[0] < c[1]]


def _by_code(own: dict, other: dict) -> tuple[dict, dict]:
    """Both blocks sorted by label, with code, the labels in numbers, and at, where a sample was."""
    codes = pa.concat_arrays([own["label"], other["label"]]).dictionary_encode().indices.to_numpy()
    both = []
    for block, code in ((own, codes[:len(own["x"])]), (other, codes[len(own["x"]):])):
        at = np.argsort(code, kind="stable")
        numbers = {name: block[name][at] for name in ("x", "p", "z") if name in block}
        both.append(numbers | {"code": code[at], "at": at})
    return tuple(both)


def _cell_sums(own: dict, other: dict, a: np.ndarray, diagonal: bool) -> tuple:
    """Kernel sums over all and over the own label: of each own sample, and of each other."""
    own, other = _by_code(own, other)
    of_rows, of_columns = np.zeros((2, len(own["x"]))), np.zeros((2, len(other["x"])))
    ones = np.ones(max(len(own["x"]), len(other["x"])))
    for rows, k, parts, _ in _strips(own, other, a, diagonal):
        of_rows[0, rows] = k @ ones[:k.shape[1]]
        of_columns[0] += ones[:len(k)] @ k
        same = of_rows[1, rows]
        for r, c in parts:
            same[r] += k[r, c].sum(axis=1)
            of_columns[1, c] += k[r, c].sum(axis=0)
    back = np.empty_like(of_rows), np.empty_like(of_columns)
    back[0][:, own["at"]], back[1][:, other["at"]] = of_rows, of_columns
    return back


def _cell_fold(own: dict, other: dict, a: np.ndarray, diagonal: bool) -> np.ndarray:
    own, other = _by_code(own, other)
    centre = own["x"].mean(axis=0)
    x, y = own["x"] - centre, other["x"] - centre
    cross, of_columns = np.zeros((x.shape[1], y.shape[1])), np.zeros(len(y))
    of_rows = np.zeros(len(x))
    ones = np.ones(max(len(x), len(y)))
    # A kernel weighs p/z - [same] 1/z of its row, and that of its column too.
    of_own, of_other = _inverse(own["z"]), _inverse(other["z"]) * (not diagonal)
    all_own, all_other = own["p"] * of_own, other["p"] * of_other
    for rows, k, parts, weight in _strips(own, other, a, diagonal):
        np.add(all_own[rows, None], all_other[None, :], out=weight)
        for r, c in parts:
            weight[r, c] -= of_own[rows][r, None] + of_other[None, c]
        k *= weight
        cross += x[rows].T @ (k @ y)
        of_rows[rows] = k @ ones[:k.shape[1]]
        of_columns += ones[:len(k)] @ k
    return x.T @ (x * of_rows[:, None]) + y.T @ (y * of_columns[:, None]) - cross - cross.T


def _inverse(z: np.ndarray) -> np.ndarray:
    return np.divide(1.0, z, out=np.zeros_like(z), where=z > 0.0)


def _sums_batch(ids, z: np.ndarray, s: np.ndarray):
    return pa.RecordBatch.from_arrays([ids, pa.array(z), pa.array(s)], names=["id", "z", "s"])


def _nearest_batch(own: dict, other: dict, distance: np.ndarray, k: int, diagonal: bool):
    order = pa.compute.sort_indices(other["id"]).to_numpy()
    if diagonal:
        distance = distance.copy()
        np.fill_diagonal(distance, np.inf)
    take = min(k, len(order) - (1 if diagonal else 0))
    by_id = distance[:, order]
    rows = picked = np.zeros(0, dtype=np.int64)
    if take:
        # All up to the distance of the last that is taken; of these the nearest, ties by id.
        last = np.partition(by_id, take - 1, axis=1)[:, take - 1]
        rows, picked = (by_id <= last[:, None]).nonzero()
        ranked = np.lexsort((picked, by_id[rows, picked], rows))
        rows, picked = rows[ranked], picked[ranked]
        starts = np.searchsorted(rows, np.arange(len(distance)))
        first = np.arange(len(rows)) - starts[rows] < take
        rows, picked = rows[first], order[picked[first]]
    return pa.RecordBatch.from_arrays(
        [
            own["id"].take(pa.array(rows)),
            other["id"].take(pa.array(picked)),
            other["label"].take(pa.array(picked)),
            pa.array(distance[rows, picked]),
        ],
        names=["id", "neighbour", "label", "distance"],
    )
