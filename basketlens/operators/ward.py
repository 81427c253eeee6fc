"""Ward's hierarchical clustering over mergeable summaries (C4).

Ward joins, again and again, the two clusters whose union adds least to the squared
distances from the means. What that needs of a cluster is its size and its mean, so rows may
be summed up first: a task keeps at most ``SUMMARIES`` clustering features (count, sum) and
joins neighbouring ones when there are more, and the tasks' features are merged alike on
their way to the driver. Up to ``SUMMARIES`` rows every row is a feature of its own and the
result is exact. The driver joins the bounded set of features by nearest-neighbour chains.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators.lloyd import gather, packed, row_draws

SUMMARIES = 2048


def _reducer(most: int) -> Callable:
    """A function that joins (counts, sums) into at most ``most`` of them, near ones together."""
    draws = row_draws()

    def reduce(counts, sums):
        import numpy as np

        if len(counts) <= most:
            return counts, sums
        means = sums / counts[:, None]
        lengths, chance = (means**2).sum(axis=1), -np.log(draws(means, 1))
        # A third of the new places goes to features at large, the rest to those far from all places.
        places, gaps = np.zeros(0, dtype=int), None
        for _ in range(3):
            weight = counts if gaps is None else counts * np.maximum(gaps, 0.0)
            with np.errstate(divide="ignore"):
                key = np.where(weight > 1e-12, chance / weight, np.inf)
            key[places] = np.inf
            new = np.argsort(key, kind="stable")[: max(1, most // 6)]
            new = new[np.isfinite(key[new])]
            if not len(new):
                break
            places = np.concatenate([places, new])
            away = np.concatenate(
                [
                    (lengths[at : at + 1024, None] - 2 * means[at : at + 1024] @ means[new].T + lengths[new]).min(axis=1)
                    for at in range(0, len(means), 1024)
                ]
            )
            gaps = away if gaps is None else np.minimum(gaps, away)
        # A few rows at a time, as a matrix of all rows and places would be most of a worker's memory.
        nearest = np.concatenate(
            [(lengths[places] - 2 * means[at : at + 1024] @ means[places].T).argmin(axis=1) for at in range(0, len(means), 1024)]
        )
        out = np.zeros((len(places), sums.shape[1]))
        np.add.at(out, nearest, sums)
        total = np.bincount(nearest, weights=counts, minlength=len(places))
        return total[total > 0], out[total > 0]

    return reduce


def clustering_features(blocks: DataFrame, most: int = SUMMARIES) -> tuple[np.ndarray, np.ndarray] | None:
    """Counts and sums of at most ``most`` groups of near rows; None without rows."""
    reduce = _reducer(most)

    def of_block(block):
        import numpy as np

        return reduce(np.ones(len(block)), block.copy())

    def merge(a, b):
        import numpy as np

        return reduce(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]))

    return gather(blocks.rdd, of_block, merge)


def ward_merges(counts: np.ndarray, sums: np.ndarray) -> list[tuple[float, int, int]]:
    """All joins as (height, a, b), a and b being features of the joined clusters, by height.

    A chain goes from each cluster to its nearest one until two are nearest to each other;
    for Ward's distance joining these is what the order by height would do too.
    """
    counts, means = counts.astype(float).copy(), sums / counts[:, None]
    alive, chain, merges = np.ones(len(counts), dtype=bool), [], []
    while alive.sum() > 1:
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        at = chain[-1]
        gaps = ((means - means[at]) ** 2).sum(axis=1) * (counts * counts[at] / (counts + counts[at]))
        gaps[~alive] = np.inf
        gaps[at] = np.inf
        nearest = int(gaps.argmin())
        # On a tie the cluster before in the chain goes first, so that the chain ends.
        if len(chain) > 1 and gaps[chain[-2]] <= gaps[nearest]:
            nearest = chain[-2]
            chain = chain[:-2]
            merges.append((float(gaps[nearest]), at, nearest))
            total = counts[at] + counts[nearest]
            means[nearest] = (counts[at] * means[at] + counts[nearest] * means[nearest]) / total
            counts[nearest], alive[at] = total, False
        else:
            chain.append(nearest)
    return sorted(merges, key=lambda merge: merge[0])


def ward_labels(counts: np.ndarray, sums: np.ndarray, k: int) -> np.ndarray:
    """The cluster of each feature after joining down to ``k``, numbered by first appearance."""
    parent = list(range(len(counts)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for _, a, b in ward_merges(counts, sums)[: max(0, len(counts) - k)]:
        parent[find(a)] = find(b)
    roots = [find(i) for i in range(len(counts))]
    number = {root: n for n, root in enumerate(dict.fromkeys(roots))}
    return np.array([number[root] for root in roots])


def hierarchical_labels(vectors: DataFrame, k: int, most: int = SUMMARIES) -> DataFrame:
    """C4: add ``prediction``, the Ward cluster of the clustering feature nearest to a row."""
    blocks = vectors.select(vector_to_array("features").alias("x")).mapInArrow(packed(), "rows long, block binary")
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = clustering_features(blocks, most)
    finally:
        blocks.unpersist()
    if found is None:
        return vectors.withColumn("prediction", F.lit(None).cast("int"))
    # Merging partitions in another order must not renumber the clusters.
    order = np.lexsort((found[1] / found[0][:, None]).T[::-1])
    counts, sums = found[0][order], found[1][order]
    return vectors.withColumn(
        "prediction", _of_nearest(sums / counts[:, None], ward_labels(counts, sums, k))(vector_to_array("features"))
    )


def _of_nearest(means: np.ndarray, labels: np.ndarray) -> Callable:
    @F.pandas_udf("int")
    def label(points: pd.Series) -> pd.Series:
        rows = np.vstack(points.to_numpy()) if len(points) else np.zeros((0, means.shape[1]))
        out, lengths = [], (means**2).sum(axis=1)
        for at in range(0, len(rows), 512):
            gaps = lengths - 2 * rows[at : at + 512] @ means.T
            out.append(labels[gaps.argmin(axis=1)])
        return pd.Series(np.concatenate(out) if out else np.zeros(0), dtype="int32")

    return label
