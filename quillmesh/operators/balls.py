"""Samples cut into balls around pivots, and which balls matter to each other.

A sample belongs to the nearest of a bounded number of pivots, under a matrix. A
pivot and the distance of the furthest sample it has make a ball; from the balls
alone follows which pairs of samples can be no nearer than a reach. Only balls
come to the driver. Pivots are drawn from the samples by a hash of their ids;
they steer what is compared, never what comes out.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pairs import vectors_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_PIVOTS = 512
# exp(-d^2) is exactly 0.0 in doubles from here on, with room for rounding.
KERNEL_REACH = math.sqrt(750.0)
_ROOM = 1e-6  # of distances, for rounding


@dataclass
class Balls:
    """Pivots moved by ``matrix``, in an order that keeps near ones together."""

    matrix: np.ndarray
    centres: np.ndarray
    counts: np.ndarray = field(default=None)
    radii: np.ndarray = field(default=None)

    def place(self, samples: DataFrame) -> DataFrame:
        """Add ball, the number of the nearest pivot, and away, the distance to it."""
        shipped = samples.sparkSession.sparkContext.broadcast((self.matrix, self.centres))
        schema = samples.select("*", F.lit(0).alias("ball"), F.lit(0.0).alias("away")).schema

        def placed(batches):
            matrix, centres = shipped.value
            for batch in batches:
                squares = distances(vectors_of(batch.column("x"), matrix.shape[1]) @ matrix.T, centres)
                ball = squares.argmin(axis=1).astype(np.int32)
                away = squares[np.arange(len(ball)), ball]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ball), pa.array(away)],
                                                 names=schema.names)

        return samples.mapInArrow(placed, schema)

    def measured(self, samples: DataFrame) -> Balls:
        """The same balls with the counts and radii of these samples."""
        counts, radii = np.zeros(len(self.centres), dtype=np.int64), np.zeros(len(self.centres))
        # Rounding of distances grows with the span of the pivots.
        span = _ROOM * float(np.linalg.norm(self.centres - self.centres.mean(axis=0), axis=1).max())
        seen = self.place(samples.select("x")).groupBy("ball").agg(F.count("*").alias("n"), F.max("away").alias("r"))
        for row in seen.collect():
            counts[row.ball], radii[row.ball] = row.n, row.r * (1 + _ROOM) + _ROOM + span
        return Balls(self.matrix, self.centres, counts, radii)

    def within(self, reach: float) -> np.ndarray:
        """(own, other) booleans: whether two samples of the balls may be within the reach."""
        return self._least(self) <= reach

    def nearest_within(self, others: Balls, k: int) -> np.ndarray:
        """(own, other): whether one of the k nearest of ``others`` to a sample of own may be in other.

        Balls of others that hold k together bound the distance of the k-th.
        """
        apart = distances(self.centres, others.centres)
        most = apart + self.radii[:, None] + others.radii[None, :]
        most[:, others.counts == 0] = np.inf
        order = np.argsort(most, axis=1)
        enough = np.cumsum(others.counts[order], axis=1) >= k
        at = np.where(enough.any(axis=1), enough.argmax(axis=1), most.shape[1] - 1)
        rows = np.arange(len(most))
        bound = np.where(enough.any(axis=1), most[rows, order[rows, at]], np.inf)
        return (self._least(others) <= bound[:, None]) & (others.counts > 0)[None, :]

    def _least(self, others: Balls) -> np.ndarray:
        apart = distances(self.centres, others.centres)
        return apart * (1 - _ROOM) - self.radii[:, None] - others.radii[None, :]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    centre = y.mean(axis=0)
    x, y = x - centre, y - centre
    squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def balls_of(samples: DataFrame, matrix, pivots: int) -> Balls:
    """Up to ``pivots`` balls around samples, with the counts and radii of all."""
    matrix = np.asarray(matrix, dtype=float)
    order = F.xxhash64(F.lit("pivot"), "id")
    drawn = samples.select("id", "x").orderBy(order, "id").limit(min(pivots, MAX_PIVOTS)).collect()
    centres = np.unique(np.array([row.x for row in drawn], dtype=float), axis=0) @ matrix.T
    return Balls(matrix, centres[_chain(centres)]).measured(samples)


def widest(samples: DataFrame, matrix) -> float:
    """No two samples are further apart: twice the furthest from one of them."""
    one = balls_of(samples, matrix, 1)
    return 2 * float(one.radii[0])


def _chain(centres: np.ndarray) -> list:
    """Each followed by the nearest one left."""
    left, order = list(range(1, len(centres))), [0]
    while left:
        near = distances(centres[order[-1:]], centres[left])[0]
        order.append(left.pop(int(near.argmin())))
    return order


def meeting_groups(near: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """(group, group): whether any ball of one is near one of the other; own and other number the groups of balls."""
    met = np.zeros((own.max() + 1, other.max() + 1), dtype=bool)
    a, b = near.nonzero()
    met[own[a], other[b]] = True
    return met


def groups_of(counts: np.ndarray, groups: int) -> np.ndarray:
    """Balls dealt to groups in their order, about as many samples to each."""
    before = np.cumsum(counts) - counts
    return np.minimum(before * groups // max(1, counts.sum()), groups - 1)
