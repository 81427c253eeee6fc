"""Many Gaussian mixtures that share their scans.

Mixtures of different seeds are fitted together: one job per step of expectation and
maximisation reads the rows once, and each task adds up, for every mixture that still moves and
every component, the rows' shares, weighted sums and weighted products. So the jobs are as many
as the longest fit has steps, however many fits there are. Starts, steps, the rule to stop and
labels are those of Spark's ``GaussianMixture``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.operators.lloyd import gather, packed

MAX_STEPS = 100
TOLERANCE = 0.01
#: Added to every density, so that a row far from all components belongs to each alike.
LEAST = float(np.finfo(float).eps)


@dataclass
class MixtureFit:
    """Weights, means and covariances of the components, the log likelihood and the steps taken."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = -np.inf
    steps: int = 0

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Label rows by their likeliest component, the lower one on a tie."""
        terms, shares = [density(m, c) for m, c in zip(self.means, self.covariances)], _shares()
        weights = self.weights

        @F.pandas_udf("int")
        def label(points: pd.Series) -> pd.Series:
            import numpy as np
            import pandas as pd

            if not len(points):
                return pd.Series([], dtype="int32")
            found = shares(np.vstack(points.to_numpy()).T, terms, weights)
            return pd.Series(found.argmax(axis=0).astype("int32"))

        return df.withColumn(name, label(vector_to_array("features")))


def density(mean: np.ndarray, covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of a normal distribution: what whitens a row, the whitened mean and the log of the factor.

    Directions without spread, but for rounding, do not count.
    """
    spread, axes = np.linalg.eigh(covariance)
    kept = spread > LEAST * spread.max() * len(spread)
    roots = np.zeros(len(spread))
    roots[kept] = np.sqrt(1.0 / spread[kept])
    whiten = roots[:, None] * axes.T
    return whiten, whiten @ mean, -0.5 * (len(mean) * np.log(2.0 * np.pi) + np.log(spread[kept]).sum())


def _shares() -> Callable:
    """A function of columns of rows and components: each one's weighted density, by component and row."""
    least = LEAST

    def shares(columns, terms, weights):
        import numpy as np

        width = len(columns)
        apart = np.concatenate([t[0] for t in terms]) @ columns
        apart -= np.concatenate([t[1] for t in terms])[:, None]
        apart *= apart
        out = apart.reshape(len(terms), width, -1).sum(axis=1)
        out *= -0.5
        out += np.array([t[2] for t in terms])[:, None]
        np.exp(out, out=out)
        out *= np.asarray(weights)[:, None]
        out += least
        return out

    return shares


def expectation() -> Callable:
    """A function of a block and several mixtures: sums per component and log likelihoods.

    The sums are those of a component's shares of the rows, of these times the rows and times
    the rows' products.
    """
    shares = _shares()

    def expect(block, terms, weights, mixtures):
        import numpy as np

        at_once, width = 512, block.shape[1]
        sums, likelihood = np.zeros((len(terms), 1 + width + width * width)), np.zeros(mixtures)
        for low in range(0, len(block), at_once):
            rows = block[low : low + at_once]
            found = shares(rows.T, terms, weights).reshape(mixtures, -1, len(rows))
            total = found.sum(axis=1)
            likelihood += np.log(total).sum(axis=1)
            found /= total[:, None, :]
            products = (rows[:, :, None] * rows[:, None, :]).reshape(len(rows), -1)
            sums += found.reshape(len(terms), -1) @ np.hstack([np.ones((len(rows), 1)), rows, products])
        return sums, likelihood

    return expect


def _maximised(fit: MixtureFit, sums: np.ndarray, likelihood: float) -> MixtureFit:
    width = fit.means.shape[1]
    share = sums[:, 0]
    means = sums[:, 1 : 1 + width] / share[:, None]
    products = sums[:, 1 + width :].reshape(-1, width, width)
    covariances = (products - share[:, None, None] * means[:, :, None] * means[:, None, :]) / share[:, None, None]
    return MixtureFit(share / share.sum(), means, covariances, float(likelihood), fit.steps + 1)


def start(vectors: DataFrame, k: int, seed: int) -> MixtureFit:
    """Where Spark's ``GaussianMixture`` starts with a seed: the model that it gives without a step."""
    model: GaussianMixtureModel = GaussianMixture(k=k, seed=seed, maxIter=0).fit(vectors)
    return MixtureFit(
        np.array(model.weights),
        np.array([g.mean.toArray() for g in model.gaussians]),
        np.array([g.cov.toArray() for g in model.gaussians]),
    )


def fit_together(
    vectors: DataFrame, starts: Sequence[MixtureFit], max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE
) -> list[MixtureFit]:
    """Fit all mixtures, each until its log likelihood changes by ``tolerance`` or less."""
    blocks = vectors.select(vector_to_array("features").alias("x")).mapInArrow(packed(), "rows long, block binary")
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    rdd, expect, fits = blocks.rdd, expectation(), list(starts)
    moving = list(range(len(fits)))
    try:
        for _ in range(max_steps):
            if not moving:
                break
            terms = [density(m, c) for i in moving for m, c in zip(fits[i].means, fits[i].covariances)]
            weights, mixtures = np.concatenate([fits[i].weights for i in moving]), len(moving)
            sums, likelihood = gather(
                rdd,
                lambda block: expect(block, terms, weights, mixtures),  # noqa: B023  the job ends in this step
                lambda a, b: (a[0] + b[0], a[1] + b[1]),
            )
            per_fit = np.split(sums, np.cumsum([len(fits[i].weights) for i in moving])[:-1])
            still = []
            for i, own, value in zip(moving, per_fit, likelihood):
                before, fits[i] = fits[i].log_likelihood, _maximised(fits[i], own, value)
                if abs(fits[i].log_likelihood - before) > tolerance:
                    still.append(i)
            moving = still
    finally:
        blocks.unpersist()
    return fits
