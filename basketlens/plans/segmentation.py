"""Fitting, storing and applying the segmentation model."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from basketlens.constants import CLUSTER_FEATURES, CLUSTER_LOG_FEATURES, CLUSTERS
from basketlens.operators.clustering import MAX_ITERATIONS, RESTARTS, SEED, fit_kmeans
from basketlens.operators.features import reference_windows, snapshot_features
from basketlens.operators.prepare import scaling, unscaled_input

ORDER_FEATURE = "avg_basket_size"


def preparation_stage(
    stats: Row,
    columns: Sequence[str] = CLUSTER_FEATURES,
    log_columns: Sequence[str] = CLUSTER_LOG_FEATURES,
) -> SQLTransformer:
    """Fill, log and scale as a model stage, with the scale written into its statement."""
    terms = []
    for name in columns:
        value = f"coalesce(CAST({name} AS DOUBLE), 0.0D)"
        if name in log_columns:
            value = f"log1p({value})"
        mean, deviation = float(stats[name].mean), float(stats[name].deviation) or 1.0
        terms.append(f"({value} - ({mean!r}D)) / ({deviation!r}D) AS scaled_{name}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def nearest_stage(
    centers: Sequence[Sequence[float]], columns: Sequence[str] = CLUSTER_FEATURES
) -> SQLTransformer:
    """The number of the nearest centre, in their order, with the centres in its statement."""

    def distance(center: Sequence[float]) -> str:
        gaps = (f"(scaled_{c} - ({float(x)!r}D))" for c, x in zip(columns, center, strict=True))
        return " + ".join(f"{gap} * {gap}" for gap in gaps)

    found = ", ".join(
        f"named_struct('distance', {distance(center)}, 'id', {place}L)" for place, center in enumerate(centers)
    )
    return SQLTransformer(statement=f"SELECT *, array_min(array({found})).id AS segment_id FROM __THIS__")


def fit_segmentation(
    features: DataFrame,
    k: int = CLUSTERS,
    seed: int = SEED,
    restarts: int = RESTARTS,
    max_iter: int = MAX_ITERATIONS,
) -> PipelineModel:
    """Scale, cluster and number the customers of a feature table.

    Segments are numbered by ascending mean basket, so that a later fit does not count
    renumbering as movement. The driver receives the scale, the centres and one mean
    per cluster.
    """
    stats = scaling(unscaled_input(features), CLUSTER_FEATURES).first()
    prepare = preparation_stage(stats)
    assemble = VectorAssembler(
        inputCols=[f"scaled_{c}" for c in CLUSTER_FEATURES], outputCol="features"
    )
    vectors = assemble.transform(prepare.transform(features))
    # The feature table is stored already; its vectors are held once, for all fits.
    vectors = vectors.select("customer_id", ORDER_FEATURE, "features")
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = fit_kmeans(vectors, k, seed, restarts, max_iter)
        means = fit.transform(vectors).groupBy("prediction").agg(F.avg(ORDER_FEATURE))
        order = [row[0] for row in sorted(means.collect(), key=lambda row: row[1])]
        # A cluster may be empty at the fit and still be the nearest of a later customer.
        order += sorted(set(range(len(fit.centers))) - set(order))
    finally:
        vectors.unpersist()
    return PipelineModel([prepare, assemble, nearest_stage([fit.centers[i] for i in order])])


def centers_of(model: PipelineModel) -> list[list[float]]:
    """The scaled centres of a fitted or stored model, in the order of their segments."""
    numbers = re.findall(r"scaled_\w+ - \(([^()]*)D\)\) \*", model.stages[-1].getStatement())
    width = len(CLUSTER_FEATURES)
    return [[float(x) for x in numbers[at : at + width]] for at in range(0, len(numbers), width)]


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The features with ``segment_id``, by the stored scale and centres."""
    scored = model.transform(features)
    return scored.select(*features.columns, "segment_id")


def feature_history(
    tables: dict[str, DataFrame],
    as_of: dt.date | None = None,
    weeks: int = 3,
    trim_web: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Features at weekly dates in one pass; ``week`` 0 is the earliest.

    Each date sees the transactions and web events up to it. ``columns`` names the
    features wanted, by default all.
    """
    days_back = tuple(range(7 * weeks, -1, -7))
    history = snapshot_features(tables, as_of, days_back, trim_web=trim_web, columns=columns)
    return history.withColumn("week", week_number(tables, as_of, weeks)).drop("as_of")


def week_number(tables: dict[str, DataFrame], as_of: dt.date | None, weeks: int) -> Column:
    newest = (
        F.lit(as_of)
        if as_of
        else reference_windows(tables.get("daily_purchases", tables.get("transactions"))).select("ref_date").scalar()
    )
    return (weeks - F.floor(F.datediff(newest, "as_of") / F.lit(7.0))).cast("long")
