"""Many K-means fits that share their scans.

Fits with different numbers of clusters and seeds move together: one job per iteration
reads the rows once, and for every fit that still moves each task adds up its rows by
nearest centre. What leaves a task is a sum and a count per centre. So the jobs are as many
as the longest fit has iterations, however many fits there are. Few rows are moved by the same
steps inside one task.

Starting centres come from a sample of at most ``SAMPLE_ROWS`` rows, which the driver clusters
once per fit by k-means++ and Lloyd steps. So the fits over all rows start near their ends and
need few iterations. Draws depend on a row's values, not on where the row lies, so a fit does
not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-4
SAMPLE_ROWS = 4096
SAMPLE_STEPS = 300
#: So many rows (some megabytes) are one task's work: its iterations need no jobs of their own.
TASK_ROWS = 1 << 17
#: So many rows at once are compared with all centres, which stays in a processor's cache.
STEP_ROWS = 2048
#: Partial sums of more partitions than this are added up on executors before they travel.
DIRECT_PARTITIONS = 64


@dataclass
class KMeansFit:
    """The centres of one fit, its cost (the sum of squared distances) and its iterations."""

    centers: np.ndarray
    cost: float
    iterations: int

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802  the name model users know
        return list(self.centers)

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Label rows by their nearest centre, the lower one on a tie."""
        return df.withColumn(name, nearest_center(self.centers)(vector_to_array("features")))


def nearest_center(centers: np.ndarray) -> Callable[[Column], Column]:
    """The number of the centre nearest to an array, the lower one on a tie."""

    @F.pandas_udf("int")
    def label(points: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd

        if not len(points):
            return pd.Series([], dtype="int32")
        columns = np.vstack(points.to_numpy()).T.copy()
        least, found = None, np.zeros(len(points), dtype="int32")
        for i, center in enumerate(centers):
            gap = np.zeros(len(points))
            for x, c in zip(columns, center):
                gap += (x - c) ** 2
            if least is None:
                least = gap
            else:
                found[gap < least] = i
                least = np.minimum(least, gap)
        return pd.Series(found)

    return label


def fit_many(
    vectors: DataFrame,
    cases: Sequence[tuple[int, int]],
    max_iter: int,
    tolerance: float = TOLERANCE,
) -> list[KMeansFit]:
    """One fit per (k, seed), in their order. ``vectors`` has the vector column ``features``.

    A fit has converged once no centre moves by more than ``tolerance``. A centre without
    rows stays. Rows are held as blocks of numbers while the fits run.
    """
    blocks = vectors.select(vector_to_array("features").alias("x")).mapInArrow(packed(), "rows long, block binary")
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _Fits(blocks, cases).run(max_iter, tolerance)
    finally:
        blocks.unpersist()


def packed() -> Callable:
    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                numbers = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("float64")
                yield pa.record_batch([pa.array([batch.num_rows]), pa.array([numbers.tobytes()])], names=["rows", "block"])

    return pack


def row_draws() -> Callable:
    """A function of a block and a seed that gives each row a number in (0, 1) by its values."""

    def draws(block, seed):
        import numpy as np

        def mixed(x):
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            return x ^ (x >> np.uint64(31))

        with np.errstate(over="ignore"):
            out = np.full(len(block), (seed * 0x9E3779B97F4A7C15 + 1) % 2**64, dtype=np.uint64)
            for column in (block + 0.0).T.copy().view(np.uint64):
                out = mixed(out * np.uint64(0xD1342543DE82EF95) + column)
        return (out >> np.uint64(11)).astype("float64") / 2**53 + 2**-54

    return draws


def gather(blocks: RDD, of_block: Callable, merge: Callable):
    """What the blocks of :func:`packed` give, merged in their tasks first; None without rows."""

    def of_partition(rows):
        import numpy as np

        total = None
        for row in rows:
            found = of_block(np.frombuffer(row["block"]).reshape(row["rows"], -1))
            total = found if total is None else merge(total, found)
        return [] if total is None else [total]

    def either(a, b):
        return b if a is None else a if b is None else merge(a, b)

    depth = 1 if blocks.getNumPartitions() <= DIRECT_PARTITIONS else 2
    return blocks.mapPartitions(of_partition).treeAggregate(None, either, either, depth=depth)


class _Fits:
    def __init__(self, blocks: DataFrame, cases: Sequence[tuple[int, int]]):
        self.cases = list(cases)
        self.rdd = blocks.rdd
        self.rows = blocks.agg(F.sum("rows")).first()[0] or 0

    def _gather(self, of_block: Callable, merge: Callable):
        return gather(self.rdd, of_block, merge)

    def _sample(self) -> np.ndarray | None:
        """The rows with the least draws, in their order; equal rows draw alike."""
        draws = row_draws()

        def least(block):
            drawn = draws(block, 0)
            at = drawn.argsort(kind="stable")[:SAMPLE_ROWS]
            return drawn[at], block[at]

        def merge(a, b):
            import numpy as np

            drawn, rows = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
            at = drawn.argsort(kind="stable")[:SAMPLE_ROWS]
            return drawn[at], rows[at]

        found = self._gather(least, merge)
        return None if found is None else found[1]

    def _step(self, centers: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """Per fit the sums and counts of the rows nearest to each centre, and the cost."""
        move = _mover()
        return self._gather(
            lambda block: move(block, centers),
            lambda a, b: [tuple(p + q for p, q in zip(x, y)) for x, y in zip(a, b)],
        )

    def starts(self) -> list[np.ndarray] | None:
        sample = self._sample()
        if sample is None:
            return None
        return [_clustered(sample, k, seed) for k, seed in self.cases]

    def run(self, max_iter: int, tolerance: float) -> list[KMeansFit]:
        starts = self.starts()
        if starts is None:
            raise ValueError("no rows to fit")
        loop = _iterations()
        if self.rows > TASK_ROWS:
            found = loop(self._step, starts, max_iter, tolerance)
        else:
            move = _mover()

            def of_all(rows):
                import numpy as np

                block = np.concatenate([np.frombuffer(r["block"]).reshape(r["rows"], -1) for r in rows])
                yield loop(lambda centers: move(block, centers), starts, max_iter, tolerance)

            found = self.rdd.coalesce(1).mapPartitions(of_all).first()
        return [KMeansFit(*fit) for fit in found]


def _mover() -> Callable:
    """A function of a block and the centres of several fits: sums, counts and cost of each."""

    def move(block, centers):
        import numpy as np

        stacked = np.vstack(centers)
        lengths, doubled = (stacked**2).sum(axis=1)[:, None], -2 * stacked
        out = [[np.zeros(own.shape), np.zeros(len(own)), 0.0] for own in centers]
        for low in range(0, len(block), STEP_ROWS):
            rows = block[low : low + STEP_ROWS]
            # Rows lie along the second axis, so that every operation runs over many of them.
            gaps, at = doubled @ rows.T + lengths, 0
            own_length = (rows**2).sum(axis=1)
            for total, own in zip(out, centers):
                part = gaps[at : at + len(own)]
                least = part.min(axis=0)
                member = (part == least).astype(float)
                if member.sum() != len(rows):
                    # A row has several nearest centres, the first of which counts, or is no number.
                    member = np.zeros(part.shape)
                    member[part.argmin(axis=0), np.arange(len(rows))] = 1.0
                total[0] += member @ rows
                total[1] += member.sum(axis=1)
                total[2] += float(np.maximum(least + own_length, 0.0).sum())
                at += len(own)
        return [tuple(total) for total in out]

    return move


def _iterations() -> Callable:
    """Lloyd iterations of several fits, given what moves them: (centres, cost, iterations) of each."""

    def loop(step, starts, max_iter, tolerance):
        centers = list(starts)
        iterations, moving = [0] * len(centers), list(range(len(centers)))
        for _ in range(max_iter):
            still = []
            for i, (sums, counts, _) in zip(moving, step([centers[i] for i in moving])):
                filled = counts > 0
                moved = centers[i].copy()
                moved[filled] = sums[filled] / counts[filled, None]
                iterations[i] += 1
                if ((moved - centers[i]) ** 2).sum(axis=1).max() > tolerance**2:
                    still.append(i)
                centers[i] = moved
            moving = still
            if not moving:
                break
        costs = [cost for _, _, cost in step(centers)]
        return list(zip(centers, costs, iterations))

    return loop


def _gaps(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    lengths = (rows**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1)
    return np.maximum(lengths - 2 * rows @ centers.T, 0.0)


def _clustered(rows: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ and Lloyd steps over the sample; fewer different rows give fewer centres."""
    random = np.random.default_rng(seed)
    centers = rows[[random.integers(len(rows))]]
    while len(centers) < k:
        gaps = _gaps(rows, centers).min(axis=1)
        gaps[gaps < 1e-12] = 0.0
        if not gaps.any():
            break
        centers = np.vstack([centers, rows[random.choice(len(rows), p=gaps / gaps.sum())]])
    for _ in range(SAMPLE_STEPS):
        label = _gaps(rows, centers).argmin(axis=1)
        member = np.zeros((len(rows), len(centers)))
        member[np.arange(len(rows)), label] = 1.0
        counts = member.sum(axis=0)
        moved = np.where(counts[:, None] > 0, member.T @ rows / np.maximum(counts, 1)[:, None], centers)
        still = ((moved - centers) ** 2).sum(axis=1).max() > TOLERANCE**2
        centers = moved
        if not still:
            break
    return centers
