"""Preparation of features for distances.

Two preparations exist side by side: the processed feature table, and the shorter
list of features that customers are clustered on. Both fill, log and scale; only
their column lists differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import (
    CLUSTER_FEATURES,
    CLUSTER_LOG_FEATURES,
    CONTEXT_COLUMNS,
    PROCESSED_FEATURES,
    PROCESSED_LOG_FEATURES,
)
from basketlens.functions.ranks import midpoint_median


def select_features(
    features: DataFrame,
    columns: Sequence[str] = PROCESSED_FEATURES,
    context: Sequence[str] = CONTEXT_COLUMNS,
) -> DataFrame:
    """Context columns and the chosen features, as doubles."""
    return features.select(*context, *[F.col(c).cast("double").alias(c) for c in columns])


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls per feature."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "feature", "null_count")


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null becomes zero."""
    return df.fillna(0.0, subset=list(columns))


def log_transform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """log(1 + x); names the frame lacks are skipped."""
    return df.withColumns({c: F.log1p(c) for c in columns if c in df.columns})


def scaling(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column, in one row.

    A constant column has its value as mean and zero as deviation, whatever rounding of
    sums would leave over.
    """
    stats = []
    for c in columns:
        constant = F.min(c) == F.max(c)
        deviation = F.when(constant, F.lit(0.0)).otherwise(F.stddev_pop(c))
        mean = F.when(constant, F.min(c)).otherwise(F.avg(c))
        stats.append(F.struct(mean.alias("mean"), deviation.alias("deviation")).alias(c))
    return df.agg(*stats)


def standard_scale(
    df: DataFrame, columns: Sequence[str], stats: DataFrame | None = None
) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes zero.

    ``stats`` is the row of an earlier :func:`scaling`, to place new rows on a known
    scale. It enters as a scalar subquery, so the rows are neither shuffled nor joined.
    """
    known = scaling(df, columns) if stats is None else stats
    # The subquery stands in one column, so it is planned once and not per feature.
    scale = known.select(F.struct(*columns)).scalar()

    def scaled(c: str) -> Column:
        deviation = F.col("_scale")[c]["deviation"]
        divisor = F.when(deviation == 0, F.lit(1.0)).otherwise(deviation)
        return (F.col(c) - F.col("_scale")[c]["mean"]) / divisor

    scaled_columns = {c: scaled(c) for c in columns}
    return df.withColumn("_scale", scale).withColumns(scaled_columns).drop("_scale")


def summary_before(df: DataFrame, columns: Sequence[str] = PROCESSED_LOG_FEATURES) -> DataFrame:
    """P5: mean, median and maximum per feature."""
    long = df.unpivot(
        [], [F.col(c).cast("double").alias(c) for c in columns], "feature", "value"
    )
    simple = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.max("value").alias("max"))
    medians = midpoint_median(long, ["feature"], "value", "median")
    return simple.join(medians, "feature", "left").select(
        "feature", "mean", "median", "max"
    )


def summary_after(df: DataFrame, columns: Sequence[str] = PROCESSED_FEATURES) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per feature, from one pass."""
    stats = df.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = stats.unpivot([], list(columns), "feature", "stats")
    return rows.select("feature", "stats.*")


def processed_features(
    features: DataFrame,
    columns: Sequence[str] = PROCESSED_FEATURES,
    log_columns: Sequence[str] = PROCESSED_LOG_FEATURES,
    stats: DataFrame | None = None,
) -> DataFrame:
    """The processed feature table."""
    unscaled = unscaled_input(features, columns, log_columns, CONTEXT_COLUMNS)
    return standard_scale(unscaled, columns, stats)


def unscaled_input(
    features: DataFrame,
    columns: Sequence[str] = CLUSTER_FEATURES,
    log_columns: Sequence[str] = CLUSTER_LOG_FEATURES,
    context: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """Chosen features filled and logged: the rows that a scale is taken from."""
    return log_transform(fill_zero(select_features(features, columns, context), columns), log_columns)


def clustering_input(
    features: DataFrame,
    columns: Sequence[str] = CLUSTER_FEATURES,
    log_columns: Sequence[str] = CLUSTER_LOG_FEATURES,
    stats: DataFrame | None = None,
    context: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """The scaled features that customers are clustered on, with their key."""
    return standard_scale(unscaled_input(features, columns, log_columns, context), columns, stats)
