"""Clustering of customers and its quality measures."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import combinations
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import GaussianMixtureModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import CLUSTER_FEATURES, CLUSTERS
from basketlens.operators.lloyd import KMeansFit, fit_many
from basketlens.operators.mixture import MixtureFit, fit_together, start
from basketlens.operators.ward import hierarchical_labels

SEED = 42
RESTARTS = 10
MAX_ITERATIONS = 300


def as_vectors(scaled: DataFrame, columns: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """Assemble the feature columns into the vector column ``features``."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(scaled)


def _restarts(vectors: DataFrame, begin, seeds: Iterable, parallel: int) -> list:
    """One start per seed; several may share the cluster at a time."""
    session_begin = inheritable_thread_target(vectors.sparkSession)(begin)
    with ThreadPool(parallel) as pool:
        return pool.map(session_begin, list(seeds))


def fit_kmeans(
    vectors: DataFrame,
    k: int = CLUSTERS,
    seed: int = SEED,
    restarts: int = RESTARTS,
    max_iter: int = MAX_ITERATIONS,
) -> KMeansFit:
    """The cheapest of several K-means fits, which share their scans."""
    cases = [(k, s) for s in range(seed, seed + restarts)]
    return min(fit_many(vectors, cases, max_iter), key=_cost)


def silhouette(labelled: DataFrame, label: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance over all rows.

    It needs only sums per cluster, so it is linear in the rows. For the value of each
    customer see :func:`silhouettes`.
    """
    labelled = labelled.withColumn(label, F.col(label).cast("double"))
    return ClusteringEvaluator(predictionCol=label).evaluate(labelled)


def _squared_length(values: Sequence[Column]) -> Column:
    return sum((v * v for v in values), F.lit(0.0))


def _cluster_sums(values: Sequence[Column]) -> list[Column]:
    """What distances to a cluster follow from: size, mean squared length, mean."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(_squared_length(values)).alias("length"),
        F.array(*[F.avg(v) for v in values]).alias("mean"),
    ]


def _widths(x: str, length: str, label: str, clusters: str) -> dict[str, Column]:
    """within, nearest and silhouette of a row, given the sums of all clusters."""

    def distance(cluster: Column) -> Column:
        products = F.zip_with(x, cluster["mean"], lambda a, m: a * m)
        product = F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
        # Rounding must not make a distance negative.
        mean = F.greatest(F.col(length) - 2 * product + cluster["length"], F.lit(0.0))
        own = cluster["other"] == F.col(label)
        return F.struct(
            own.alias("own"),
            F.when(own, F.try_divide(mean * cluster["n"], cluster["n"] - 1))
            .otherwise(mean)
            .alias("mean"),
        )

    means = F.transform(clusters, distance)

    def least(own: bool) -> Column:
        return F.array_min(
            F.transform(F.filter(means, lambda d: d["own"] == F.lit(own)), lambda d: d["mean"])
        )

    width = (F.col("nearest") - F.col("within")) / F.greatest("nearest", "within")
    return {
        "within": least(True),
        "nearest": least(False),
        # A customer alone in its cluster counts as zero.
        "silhouette": F.when(F.col("within").isNull(), F.lit(0.0)).otherwise(width),
    }


def silhouettes(
    labelled: DataFrame,
    columns: Sequence[str] = CLUSTER_FEATURES,
    label: str = "prediction",
) -> DataFrame:
    """The silhouette of every customer, with squared Euclidean distance.

    The mean squared distance of a point x to a cluster is |x|^2 - 2 x.m + q, where m is
    the cluster's mean and q the mean of its squared lengths; for the own cluster that
    counts the point itself and is scaled up by n / (n - 1). So one small aggregate per
    cluster, a scalar of the plan, serves all rows, and no rows are paired or shuffled.
    """
    values = [F.col(c).cast("double") for c in columns]
    clusters = labelled.groupBy(F.col(label).cast("long").alias("other")).agg(
        *_cluster_sums(values)
    )
    clusters = clusters.agg(F.collect_list(F.struct("other", "n", "length", "mean"))).scalar()
    rows = labelled.select(
        "customer_id",
        F.col(label).cast("long").alias("segment_id"),
        F.array(*values).alias("_x"),
        _squared_length(values).alias("_length"),
        clusters.alias("_clusters"),
    )
    widths = _widths("_x", "_length", "segment_id", "_clusters")
    silhouette_width = widths.pop("silhouette")
    return (
        rows.withColumns(widths)
        .withColumn("silhouette", silhouette_width)
        .drop("_x", "_length", "_clusters")
    )


def run_silhouettes(
    labelled: DataFrame, runs: Sequence[str], columns: Sequence[str] = CLUSTER_FEATURES
) -> DataFrame:
    """The mean silhouette of several labellings of the same rows, in one job.

    ``labelled`` has the vector column ``features`` or the named ``columns``. A run that
    puts all rows into one cluster has none.
    """
    if "features" in labelled.columns:
        return _vector_silhouettes(labelled, runs)
    point = F.array(*[F.col(c).cast("double") for c in columns])
    labels = F.array(
        *[F.struct(F.lit(r).alias("run"), F.col(r).cast("long").alias("label")) for r in runs]
    )
    rows = labelled.select(point.alias("_x"), F.explode(labels).alias("_r")).select("_x", "_r.*")
    values = [F.get("_x", F.lit(i)) for i in range(len(columns))]
    clusters = (
        rows.groupBy("run", F.col("label").alias("other"))
        .agg(*_cluster_sums(values))
        .groupBy("run")
        .agg(F.collect_list(F.struct("other", "n", "length", "mean")).alias("_clusters"))
    )
    widths = _widths("_x", "_length", "label", "_clusters")
    silhouette_width = widths.pop("silhouette")
    return (
        rows.withColumn("_length", _squared_length(values))
        .join(F.broadcast(clusters), "run")  # one row per run
        .withColumns(widths)
        .withColumn("silhouette", F.when(F.size("_clusters") > 1, silhouette_width))
        .groupBy("run")
        .agg(F.avg("silhouette").alias("silhouette"))
    )


def _vector_silhouettes(labelled: DataFrame, runs: Sequence[str]) -> DataFrame:
    """:func:`run_silhouettes` of vectors, whose tasks add up blocks of rows."""
    rows = labelled.select(vector_to_array("features").alias("x"), *[F.col(r).cast("long").alias(f"label_{i}") for i, r in enumerate(runs)])
    sums = rows.mapInArrow(_label_sums(), "run int, label long, n long, length double, total array<double>")
    at = F.posexplode("total").alias("place", "value")
    means = sums.select("run", "label", at).groupBy("run", "label", "place").agg(F.sum("value").alias("value"))
    means = means.groupBy("run", "label").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("total"))
    sizes = sums.groupBy("run", "label").agg(F.sum("n").alias("n"), F.sum("length").alias("length"))
    # A row per cluster of each run.
    found = sizes.join(means, ["run", "label"]).orderBy("run", "label").collect()
    clusters = []
    for i in range(len(runs)):
        own = [c for c in found if c["run"] == i]
        n = np.array([c["n"] for c in own], dtype=float)
        mean = np.array([[v["value"] for v in c["total"]] for c in own])
        clusters.append((np.array([c["label"] for c in own]), n, np.array([c["length"] for c in own]) / n, mean / n[:, None] if own else mean))
    names = F.array(*[F.lit(r) for r in runs])
    parts = rows.mapInArrow(_label_widths(clusters), "run int, width double, rows long")
    several = F.array(*[F.lit(len(c[0]) > 1) for c in clusters])
    totals = parts.groupBy("run").agg((F.sum("width") / F.sum("rows")).alias("mean"))
    return totals.select(F.get(names, "run").alias("run"), F.when(F.get(several, "run"), F.col("mean")).alias("silhouette"))


def _label_sums() -> Callable:
    """Size, sum of squared lengths and sum of the rows of each label of each run."""

    def sums(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            points = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            lengths, out = (points**2).sum(axis=1), []
            for run in range(batch.num_columns - 1):
                found, member = np.unique(batch.column(run + 1).to_numpy(), return_inverse=True)
                total = np.zeros((len(found), points.shape[1]))
                np.add.at(total, member, points)
                counts = np.bincount(member)
                out += zip([run] * len(found), found.tolist(), counts.tolist(), np.bincount(member, lengths).tolist(), total.tolist())
            types = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], names=["run", "label", "n", "length", "total"]
            )

    return sums


def _label_widths(clusters: list) -> Callable:
    """Per run the sum of the rows' silhouettes and their number; a row alone in its cluster counts as zero."""

    def widths(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            points = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            lengths, at, sums = (points**2).sum(axis=1)[:, None], np.arange(batch.num_rows), []
            for run, (labels, n, length, means) in enumerate(clusters):
                gaps = np.maximum(lengths - 2 * points @ means.T + length, 0.0)
                own = np.searchsorted(labels, batch.column(run + 1).to_numpy())
                within = gaps[at, own] * n[own] / np.maximum(n[own] - 1, 1)
                gaps[at, own] = np.inf
                nearest = gaps.min(axis=1) if len(labels) > 1 else within
                largest = np.maximum(within, nearest)
                valued = (n[own] > 1) & (largest > 0)
                sums.append(float(((nearest - within)[valued] / largest[valued]).sum()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(clusters)), pa.int32()), pa.array(sums), pa.array([batch.num_rows] * len(clusters), pa.int64())],
                names=["run", "width", "rows"],
            )

    return widths


def k_selection(
    vectors: DataFrame,
    ks: Iterable[int] = range(2, 11),
    seed: int = SEED,
    restarts: int = RESTARTS,
    max_iter: int = MAX_ITERATIONS,
) -> DataFrame:
    """Inertia and silhouette for each number of clusters.

    All fits share their scans, and one job labels the rows by every kept fit and scores
    all labellings.
    """
    ks = list(ks)
    cases = [(k, s) for k in ks for s in range(seed, seed + restarts)]
    fits = fit_many(vectors, cases, max_iter)
    best = [min((f for f, case in zip(fits, cases, strict=True) if case[0] == k), key=_cost) for k in ks]
    runs = [f"run_{i}" for i in range(len(ks))]
    dimensions = range(len(best[0].clusterCenters()[0]))
    scores = dict(run_silhouettes(label_runs(vectors, best), runs, dimensions).collect())
    rows = [(k, _cost(m), scores[run]) for k, m, run in zip(ks, best, runs, strict=True)]
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def _cost(fit: KMeansFit) -> float:
    return fit.cost


def mixture_starts(
    vectors: DataFrame, seed: int, k: int = CLUSTERS, restarts: int = 3, parallel: int = 1
) -> list[MixtureFit]:
    """Gaussian mixtures started from one seed."""
    return fit_mixtures(vectors, [seed], k, restarts, parallel)[0]


def fit_mixtures(
    vectors: DataFrame,
    seeds: Sequence[int],
    k: int = CLUSTERS,
    restarts: int = 3,
    parallel: int = 1,
) -> list[list[MixtureFit]]:
    """The mixtures of all starts of all seeds, fitted together."""

    def begin(run_seed: int) -> MixtureFit:
        return start(vectors, k, run_seed)

    starts = [seed * restarts + i for seed in seeds for i in range(restarts)]
    models = fit_together(vectors, _restarts(vectors, begin, starts, parallel))
    return [models[at : at + restarts] for at in range(0, len(models), restarts)]


def _likeliest(models: Sequence[MixtureFit]) -> MixtureFit:
    return max(models, key=lambda model: model.log_likelihood)


def fit_mixture(
    vectors: DataFrame, seed: int, k: int = CLUSTERS, restarts: int = 3, parallel: int = 1
) -> MixtureFit:
    """The likeliest of several Gaussian mixtures started from one seed."""
    return _likeliest(mixture_starts(vectors, seed, k, restarts, parallel))


def likeliest_mixtures(
    vectors: DataFrame, seeds: Sequence[int], k: int = CLUSTERS
) -> list[MixtureFit]:
    """The mixture of each seed, all starts fitted together."""
    return [_likeliest(models) for models in fit_mixtures(vectors, seeds, k)]


def label_runs(vectors: DataFrame, models: Sequence, prefix: str = "run_") -> DataFrame:
    """Label the rows by each model, one column per run; no rows are shuffled."""
    labelled = vectors
    for i, model in enumerate(models):
        if isinstance(model, (KMeansFit, MixtureFit)):
            labelled = model.transform(labelled, f"{prefix}{i}")
            continue
        named = model.copy().setPredictionCol(f"{prefix}{i}")
        if isinstance(model, GaussianMixtureModel):
            named = named.setProbabilityCol(f"_probability_{i}")
        labelled = named.transform(labelled)
    return labelled.drop(*[f"_probability_{i}" for i in range(len(models))])


def label_agreement(labelled: DataFrame, runs: Sequence[str]) -> DataFrame:
    """For each pair of runs the share of equal labels.

    Cluster numbers are arbitrary, so ``matched_agreement`` first renames the labels of one
    run to those of the other, each to a different one, such that most rows agree; labels
    left over agree with none. Rows are counted per combination of labels at once; all pairs
    follow from those counts, of which a pair has as many as products of its labels.
    """
    combos = labelled.groupBy(*runs).agg(F.count("*").alias("rows"))
    pairs = F.array(
        *[
            F.struct(
                F.lit(a).alias("run_a"),
                F.lit(b).alias("run_b"),
                F.col(a).cast("long").alias("label_a"),
                F.col(b).cast("long").alias("label_b"),
            )
            for a, b in combinations(runs, 2)
        ]
    )
    overlap = (
        combos.select(F.inline(pairs), "rows")
        .groupBy("run_a", "run_b", "label_a", "label_b")
        .agg(F.sum("rows").alias("rows"))
    )
    equal = F.when(F.col("label_a") == F.col("label_b"), F.col("rows")).otherwise(0)
    agreement = overlap.groupBy("run_a", "run_b").agg(
        F.sum("rows").alias("total"), (F.sum(equal) / F.sum("rows")).alias("agreement")
    )
    matched = overlap.groupBy("run_a", "run_b").applyInPandas(
        _matched_rows(), "run_a string, run_b string, matched double"
    )
    return agreement.join(matched, ["run_a", "run_b"]).select(
        "run_a", "run_b", "agreement", (F.col("matched") / F.col("total")).alias("matched_agreement")
    )


def matcher() -> Callable[[np.ndarray], float]:
    """The function below, in a form that tasks need no installed package for."""

    def best_matching(weights: np.ndarray) -> float:
        """The largest sum of entries of a matrix, no two in one row or column.

        Rows are taken in one after the other. Prices of rows and columns are kept such that the
        cheapest path of renamings that frees a column for the new row is found by adding up.
        """
        size = max(weights.shape)
        cost = np.zeros((size, size))
        cost[: weights.shape[0], : weights.shape[1]] = weights.max() - weights
        cost[weights.shape[0] :, :] = cost[:, weights.shape[1] :] = weights.max()
        row_price, column_price = np.zeros(size), np.zeros(size + 1)
        owner = np.full(size + 1, -1)
        for row in range(size):
            at, owner[size] = size, row
            least, back, done = np.full(size, np.inf), np.full(size, size), np.zeros(size + 1, dtype=bool)
            while owner[at] >= 0:
                done[at] = True
                free = ~done[:size]
                slack = cost[owner[at]] - row_price[owner[at]] - column_price[:size]
                shorter = free & (slack < least)
                least[shorter], back[shorter] = slack[shorter], at
                nearest = int(np.where(free, least, np.inf).argmin())
                step = least[nearest]
                row_price[owner[done]] += step
                column_price[done] -= step
                least[free] -= step
                at = nearest
            while at != size:
                owner[at], at = owner[back[at]], back[at]
        matched = [(owner[c], c) for c in range(weights.shape[1]) if owner[c] < weights.shape[0]]
        return sum(weights[r, c] for r, c in matched)

    return best_matching


def _matched_rows() -> Callable[[pd.DataFrame], pd.DataFrame]:
    best = matcher()

    def of_pair(overlap: pd.DataFrame) -> pd.DataFrame:
        table = overlap.pivot_table(index="label_a", columns="label_b", values="rows", aggfunc="sum", fill_value=0)
        found = {name: [overlap[name].iloc[0]] for name in ("run_a", "run_b")}
        return pd.DataFrame(found | {"matched": [float(best(table.to_numpy()))]})

    return of_pair


def compare_methods(
    vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED, mixture_seeds: Sequence[int] = range(5)
) -> DataFrame:
    """Silhouettes of the three methods and how far mixture runs agree."""
    mixtures = likeliest_mixtures(vectors, mixture_seeds, k)
    labelled = label_runs(vectors, [fit_kmeans(vectors, k, seed)], "kmeans_")
    labelled = hierarchical_labels(labelled, k).withColumnRenamed("prediction", "split_0")
    labelled = label_runs(labelled, mixtures)
    runs = [f"run_{i}" for i in range(len(mixtures))]
    dimensions = range(mixtures[0].means.shape[1]) if mixtures else CLUSTER_FEATURES
    return method_table(labelled, "kmeans_0", "split_0", runs, dimensions)


def method_table(
    labelled: DataFrame,
    kmeans: str,
    hierarchical: str,
    mixtures: Sequence[str],
    columns: Sequence = CLUSTER_FEATURES,
) -> DataFrame:
    """The comparison of labellings: their silhouettes, and the mixtures' agreement."""
    names = [kmeans, hierarchical, *mixtures]
    scores = dict(run_silhouettes(labelled, names, columns).collect())
    known = [scores[m] for m in mixtures if scores[m] is not None]
    agreement = label_agreement(labelled, mixtures).agg(
        F.avg("agreement"), F.avg("matched_agreement")
    ).first()
    rows = [
        ("K-Means", "silhouette", scores[kmeans]),
        ("Hierarchical", "silhouette", scores[hierarchical]),
        ("GMM (best)", "silhouette", max(known, default=None)),
        ("GMM (worst)", "silhouette", min(known, default=None)),
        ("GMM agreement", "share of equal labels", agreement[0]),
        ("GMM agreement, matched labels", "share of equal labels", agreement[1]),
    ]
    return labelled.sparkSession.createDataFrame(
        rows, "method string, measure string, value double"
    )


def squared_distance(columns: Sequence[str], center: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for name, value in zip(columns, center, strict=True):
        gap = F.col(name) - F.lit(float(value))
        total = total + gap * gap
    return total


def assign_nearest(
    scaled: DataFrame,
    centers: dict[int, Sequence[float]],
    columns: Sequence[str] = CLUSTER_FEATURES,
    name: str = "segment_id",
) -> DataFrame:
    """The nearest of some given centres, the lower number on a tie.

    The centres are few numbers and stand in the expression, so rows are scored where
    they are, without a join.
    """
    distances = [
        F.struct(squared_distance(columns, center).alias("distance"), F.lit(i).alias("id"))
        for i, center in sorted(centers.items())
    ]
    nearest = F.least(*distances) if len(distances) > 1 else distances[0]
    return scaled.withColumn(name, nearest["id"].cast("long"))
