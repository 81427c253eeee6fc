"""Steps of the fits that must not grow faster than the rows."""

from __future__ import annotations

import tracemalloc

import numpy as np
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.linalg import Vectors

from basketlens.operators import clustering, lloyd, mixture, ward


def test_silhouettes_of_vectors_do_not_repeat_rows_per_run(spark):
    points = np.round(np.random.default_rng(1).standard_normal((60, 3)), 1)
    rows = [(i, Vectors.dense(p), i % 3, int(i == 7), 0) for i, p in enumerate(points)]
    labelled = spark.createDataFrame(rows, ["customer_id", "features", "a", "b", "c"])
    scores = clustering.run_silhouettes(labelled, ["a", "b", "c"], range(3))
    assert "explode(" not in scores._jdf.queryExecution().analyzed().toString()
    found = {row["run"]: row["silhouette"] for row in scores.collect()}
    gaps = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    for run, label in (("a", np.arange(60) % 3), ("b", (np.arange(60) == 7).astype(int))):
        values = []
        for i in range(60):
            own = label == label[i]
            if own.sum() == 1:
                values.append(0.0)
                continue
            within = gaps[i, own].sum() / (own.sum() - 1)
            nearest = min(gaps[i, label == other].mean() for other in set(label) - {label[i]})
            values.append((nearest - within) / max(nearest, within))
        assert abs(found[run] - np.mean(values)) < 1e-9
    assert found["c"] is None


def test_a_step_holds_few_distances_at_once():
    block = np.random.default_rng(2).standard_normal((20_000, 4))
    block[:500] = block[0]
    centers = [block[:k].copy() for k in (1, 3, 501)]  # equal centres: the first one has the rows
    move = lloyd._mover()
    tracemalloc.start()
    found = move(block, centers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000 * 505 * 8 / 2
    for own, (sums, counts, cost) in zip(centers, found):
        gaps = ((block[:, None, :] - own[None]) ** 2).sum(axis=2)
        label = gaps.argmin(axis=1)
        assert counts.sum() == len(block) and (counts[1:500] == 0).all()
        assert abs(cost - gaps.min(axis=1).sum()) < 1e-6 * max(1.0, cost)
        assert np.allclose(sums, [block[label == i].sum(axis=0) for i in range(len(own))])


def test_summing_up_rows_holds_few_distances_at_once():
    block = np.random.default_rng(3).standard_normal((10_000, 4))
    reduce = ward._reducer(1024)
    tracemalloc.start()
    counts, sums = reduce(np.ones(len(block)), block.copy())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000 * 512 * 8 / 2
    assert counts.sum() == 10_000 and len(counts) <= 1024
    assert np.allclose(sums.sum(axis=0), block.sum(axis=0))


def test_mixtures_share_their_steps_and_equal_single_fits(spark, monkeypatch):
    random = np.random.default_rng(4)
    points = np.concatenate([random.standard_normal((150, 3)) * size + at for size, at in ((1.0, 0.0), (0.3, 4.0), (2.0, -5.0))])
    points[:, 2] = np.round(points[:, 2] / 3)
    vectors = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points)], ["customer_id", "features"]).repartition(3).cache()
    jobs, real = [], mixture.gather
    monkeypatch.setattr(mixture, "gather", lambda *given: jobs.append(1) or real(*given))
    fits = [fit for own in clustering.fit_mixtures(vectors, [0, 1], k=3, restarts=2) for fit in own]
    assert len(jobs) == max(fit.steps for fit in fits) < sum(fit.steps for fit in fits)
    for seed, fit in enumerate(fits):
        alone = GaussianMixture(k=3, seed=seed).fit(vectors)
        assert fit.steps == alone.summary.numIter
        assert abs(fit.log_likelihood - alone.summary.logLikelihood) < 1e-6
        assert np.allclose(fit.weights, alone.weights) and np.allclose(fit.means, [g.mean.toArray() for g in alone.gaussians])
        labelled = clustering.label_runs(vectors, [fit, alone])
        assert labelled.where("run_0 <> run_1").count() == 0
    vectors.unpersist()
