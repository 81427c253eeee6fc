"""Segment profiles, names and assignments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.constants import COMPARISON_FEATURES, NAME_RULES, PROFILE_FEATURES
from basketlens.functions.numeric import round_to, with_share


def profile_segments(
    segmented: DataFrame,
    columns: Sequence[str] = PROFILE_FEATURES,
    segment: str = "segment_id",
) -> DataFrame:
    """Mean of raw features per segment, size and share.

    Nulls are left out of a mean here, although they count as zero in distances.
    """
    profiles = segmented.groupBy(segment).agg(
        *[round_to(F.avg(c), 3).alias(c) for c in columns], F.count("*").alias("customer_count")
    )
    return with_share(profiles, "customer_count", "pct_of_total")


def name_scores(rules: Sequence[tuple[str, dict[str, float]]] = NAME_RULES) -> list[Column]:
    """Each rule's score, ready to be compared: ties go to the earlier rule."""
    scored = []
    for order, (name, weights) in enumerate(rules):
        score = F.lit(0.0)
        for feature, weight in weights.items():
            score = score + F.col(feature) * F.lit(weight)
        scored.append(
            F.struct(
                score.alias("score"), F.lit(-order).alias("priority"), F.lit(name).alias("name")
            )
        )
    return scored


def name_segments(
    profiles: DataFrame,
    rules: Sequence[tuple[str, dict[str, float]]] = NAME_RULES,
    segment: str = "segment_id",
) -> DataFrame:
    """The name with the highest score, and whether a lower segment has it already."""
    scored = name_scores(rules)
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    named = profiles.withColumn("segment_name", best["name"])
    same_name = Window.partitionBy("segment_name").orderBy(segment)
    return named.withColumn("is_duplicate", F.row_number().over(same_name) > 1)


def profile_long(
    profiles: DataFrame,
    columns: Sequence[str] = COMPARISON_FEATURES,
    segment: str = "segment_id",
) -> DataFrame:
    """C14: one row per segment and compared feature."""
    values = [F.col(c).cast("double").alias(c) for c in columns]
    return profiles.unpivot([segment], values, "feature", "value")


def segment_assignments(
    segmented: DataFrame, names: DataFrame, as_of: dt.date | Column
) -> DataFrame:
    """The assignment table; ``names`` has one row per segment."""
    date = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return (
        segmented.select("customer_id", F.col("segment_id").cast("long").alias("segment_id"))
        .join(F.broadcast(names.select("segment_id", "segment_name")), "segment_id", "left")
        .select(
            "customer_id", "segment_id", "segment_name", date.cast("date").alias("assignment_date")
        )
    )


def run_summary(assignments: DataFrame, feature_count: int, silhouette: float) -> DataFrame:
    """Customers per segment and in all, features used, silhouette."""
    sizes = assignments.groupBy("segment_id", "segment_name").agg(
        F.count("*").alias("customer_count")
    )
    return sizes.select(
        "*",
        F.sum("customer_count").over(Window.partitionBy()).alias("customers"),
        F.lit(feature_count).alias("features_used"),
        F.lit(silhouette).alias("silhouette"),
    ).orderBy("segment_id")
