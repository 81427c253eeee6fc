"""Checks after each refresh (D1-D5); alerts are columns, not messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import (
    DRIFT_FEATURES,
    LARGE_SEGMENT_PCT,
    MIGRATION_ALERT,
    MIN_TRANSACTIONS,
    SMALL_SEGMENT_PCT,
)
from basketlens.functions.numeric import round_to, with_share

#: Size of a quantile sketch, and by how much its ranks may be wrong (in 99 of 100 cases).
SKETCH_SIZE = 800
SKETCH_ERROR = 0.0045
#: Distributions are compared at so many quantiles.
QUANTILES = 200


def _segment_shares(assignments: DataFrame) -> DataFrame:
    sizes = assignments.groupBy("segment_name").agg(F.count("*").alias("customer_count"))
    return with_share(sizes, "customer_count", "pct_of_total")


def segment_distribution(
    assignments: DataFrame,
    previous: DataFrame | None = None,
    smallest: float = SMALL_SEGMENT_PCT,
    largest: float = LARGE_SEGMENT_PCT,
) -> DataFrame:
    """Size and share per segment, largest first, with an alert at unusual shares.

    Given the previous refresh, ``pct_change`` is the change in share since then;
    a segment that vanished is listed with no customers.
    """
    shares = _segment_shares(assignments)
    if previous is not None:
        before = _segment_shares(previous).select(
            "segment_name", F.col("pct_of_total").alias("_before")
        )
        shares = (
            shares.join(before, "segment_name", "full_outer")
            .fillna({"customer_count": 0, "pct_of_total": 0.0, "_before": 0.0})
            .withColumn("pct_change", round_to(F.col("pct_of_total") - F.col("_before"), 1))
            .drop("_before")
        )
    share = F.col("pct_of_total")
    return shares.withColumn(
        "alert", F.when(share < smallest, "too small").when(share > largest, "too large")
    ).orderBy(F.desc("customer_count"), "segment_name")


def new_customers(
    transactions: DataFrame, assignments: DataFrame, min_transactions: int = MIN_TRANSACTIONS
) -> DataFrame:
    """Customers below the threshold, eligible but unassigned, and assigned."""
    counts = transactions.groupBy("customer_id").agg(F.count("*").alias("txn_count"))
    assigned = assignments.select("customer_id", F.lit(True).alias("is_assigned")).distinct()
    is_assigned = F.col("is_assigned").isNotNull()
    return counts.join(assigned, "customer_id", "left").agg(
        F.count_if(F.col("txn_count") < min_transactions).alias("below_threshold"),
        F.count_if((F.col("txn_count") >= min_transactions) & ~is_assigned).alias(
            "eligible_unassigned"
        ),
        F.count_if(is_assigned).alias("currently_assigned"),
    )


def latest_migration(log: DataFrame, threshold: float = MIGRATION_ALERT) -> DataFrame:
    """D3: the newest week of the migration log, with an alert above the threshold."""
    return (
        log.orderBy(F.desc("week"))
        .limit(1)
        .withColumn("alert", F.col("migration_rate") > threshold)
    )


def feature_stats(features: DataFrame) -> DataFrame:
    """Means of five features and the deviation of the basket."""
    return features.agg(
        round_to(F.avg("avg_basket_size"), 2).alias("mean_basket"),
        round_to(F.stddev_samp("avg_basket_size"), 2).alias("std_basket"),
        round_to(F.avg("promo_purchase_ratio"), 4).alias("mean_promo"),
        round_to(F.avg("online_ratio"), 4).alias("mean_online"),
        round_to(F.avg("days_since_last_purchase"), 0).alias("mean_recency"),
        round_to(F.avg("frequency_trend"), 4).alias("mean_trend"),
    )


def feature_drift(
    before: DataFrame,
    after: DataFrame,
    columns: Sequence[str] = DRIFT_FEATURES,
    limit: float = 0.5,
) -> DataFrame:
    """Change of each feature's mean between refreshes, in deviations of the earlier one."""

    def stats(df: DataFrame, suffix: str) -> DataFrame:
        rows = df.agg(
            *[
                F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c)
                for c in columns
            ]
        ).unpivot([], list(columns), "feature", "s")
        return rows.select(
            "feature",
            F.col("s.mean").alias(f"mean_{suffix}"),
            F.col("s.std").alias(f"std_{suffix}"),
        )

    joined = stats(before, "before").join(stats(after, "after"), "feature")
    shift = F.try_divide(F.col("mean_after") - F.col("mean_before"), F.col("std_before"))
    return joined.select(
        "feature",
        "mean_before",
        "mean_after",
        "std_before",
        shift.alias("shift_in_deviations"),
        (F.abs(shift) > limit).alias("alert"),
    )


def feature_sketches(
    features: DataFrame, columns: Sequence[str] = DRIFT_FEATURES, k: int = SKETCH_SIZE
) -> DataFrame:
    """The distribution of each feature as a mergeable quantile sketch: feature, n, sketch.

    One aggregate whose state per feature is bounded by ``k``, however many customers there
    are; a few kilobytes per feature are all that a later comparison needs of a refresh.
    """
    long = features.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "feature", "value")
    return long.groupBy("feature").agg(
        F.count("value").alias("n"), F.kll_sketch_agg_double("value", k).alias("sketch")
    )


def distribution_drift(before: DataFrame, after: DataFrame, limit: float = 0.1) -> DataFrame:
    """How far the distribution of each feature moved between two refreshes.

    ``largest_shift`` is the largest gap between the shares of customers at or below a value,
    over the quantiles of both refreshes; ``value`` is where it lies. Between 0 and 1, it is
    exact up to a step between quantiles and twice the error of a sketch, ``SKETCH_ERROR``. A
    mean may stay while it is large.
    """
    steps = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES + 1)])
    known = (F.col("n_before") > 0) & (F.col("n_after") > 0)
    joined = before.select("feature", F.col("n").alias("n_before"), F.col("sketch").alias("sketch_before")).join(
        after.select("feature", F.col("n").alias("n_after"), F.col("sketch").alias("sketch_after")), "feature"
    )
    ranked = joined.where(known).withColumns(
        {t: F.kll_sketch_get_quantile_double(f"sketch_{t}", steps) for t in ("before", "after")}
    )

    def share(quantiles: str, value: Column) -> Column:
        return F.size(F.filter(quantiles, lambda q: q <= value)) / F.lit(QUANTILES)

    gaps = F.transform(
        F.array_distinct(F.concat("before", "after")),
        lambda x: F.struct(
            F.abs(share("after", x) - share("before", x)).alias("shift"),
            (-x).alias("place"),
            share("before", x).alias("share_before"),
            share("after", x).alias("share_after"),
        ),
    )
    return ranked.withColumn("largest", F.array_max(gaps)).select(
        "feature",
        "n_before",
        "n_after",
        (-F.col("largest.place")).alias("value"),
        "largest.share_before",
        "largest.share_after",
        F.col("largest.shift").alias("largest_shift"),
        (F.col("largest.shift") > limit).alias("alert"),
    )
