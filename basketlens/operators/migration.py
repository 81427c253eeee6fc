"""Movement of customers between refreshes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import MIGRATION_ALERT
from basketlens.functions.numeric import round_to

MARGIN = "All"


def _moves(before: DataFrame, after: DataFrame, how: str) -> DataFrame:
    old = before.select("customer_id", F.col("segment_id").alias("from_segment"))
    new = after.select("customer_id", F.col("segment_id").alias("to_segment"))
    return old.join(new, "customer_id", how)


def _rate(shifted: Column, customers: Column) -> Column:
    return F.try_divide(shifted, customers)


def migration(
    before: DataFrame, after: DataFrame, threshold: float = MIGRATION_ALERT
) -> DataFrame:
    """How many customers changed segment between two refreshes.

    The rate is over customers in both. Those only in one are counted as entered or
    left. A refresh is stable strictly below the threshold.
    """
    old, new = F.col("from_segment"), F.col("to_segment")
    counts = _moves(before, after, "full_outer").agg(
        F.count_if(old.isNotNull() & new.isNotNull()).alias("customers"),
        F.count_if(old != new).alias("customers_shifted"),
        F.count_if(old.isNull()).alias("customers_entered"),
        F.count_if(new.isNull()).alias("customers_left"),
    )
    rate = _rate(F.col("customers_shifted"), F.col("customers"))
    return counts.select(
        "customers",
        "customers_shifted",
        round_to(rate, 4).alias("migration_rate"),
        (rate < threshold).alias("stability_pass"),
        "customers_entered",
        "customers_left",
    )


def migration_matrix(before: DataFrame, after: DataFrame) -> DataFrame:
    """Customers per old and new segment in long form, with margins named ``All``.

    The cube runs over the counted cells, not over the customers.
    """
    cells = (
        _moves(before, after, "inner")
        .groupBy("from_segment", "to_segment")
        .agg(F.count("*").alias("customers"))
    )

    def label(column: str) -> Column:
        return F.when(F.grouping(column) == 1, MARGIN).otherwise(F.col(column).cast("string"))

    return cells.cube("from_segment", "to_segment").agg(
        label("from_segment").alias("from_label"),
        label("to_segment").alias("to_label"),
        F.sum("customers").alias("customers"),
    ).select(
        F.col("from_label").alias("from_segment"), F.col("to_label").alias("to_segment"), "customers"
    )


def wide_matrix(matrix: DataFrame, segments: list[str]) -> DataFrame:
    """The matrix with one column per new segment."""
    return (
        matrix.groupBy("from_segment")
        .pivot("to_segment", [*segments, MARGIN])
        .agg(F.sum("customers"))
        .fillna(0)
        .orderBy(F.col("from_segment") == MARGIN, "from_segment")
    )


def migration_log(
    history: DataFrame, threshold: float = MIGRATION_ALERT, against: str = "first"
) -> DataFrame:
    """One row per later week of ``history`` (week, customer_id, segment_id).

    Weeks are compared with week 0, or with ``against="previous"`` with the week before.
    One join serves all weeks.
    """
    later = history.where(F.col("week") > 0).select(
        "week", "customer_id", F.col("segment_id").alias("to_segment")
    )
    earlier = history.select(
        F.col("week").alias("_week"), "customer_id", F.col("segment_id").alias("from_segment")
    )
    if against == "first":
        joined = later.join(earlier.where(F.col("_week") == 0), "customer_id")
    elif against == "previous":
        following = earlier.select((F.col("_week") + 1).alias("week"), "customer_id", "from_segment")
        joined = later.join(following, ["customer_id", "week"])
    else:
        raise ValueError(f"against must be 'first' or 'previous', not {against!r}")
    counts = joined.groupBy("week").agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("from_segment") != F.col("to_segment")).alias("customers_shifted"),
    )
    rate = _rate(F.col("customers_shifted"), F.col("customers"))
    return counts.select(
        F.col("week").cast("long").alias("week"),
        "customers_shifted",
        round_to(rate, 4).alias("migration_rate"),
        (rate < threshold).alias("stability_pass"),
    ).orderBy("week")
