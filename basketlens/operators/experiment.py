"""Treatment and control in a campaign test.

Every test statistic follows from counts, means and variances per group, which one
aggregation over the results delivers. Probabilities are column expressions on that
single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.functions.probability import normal_two_sided, student_two_sided
from basketlens.functions.ranks import value_at_rank

OUTCOMES = ("opened", "clicked", "converted")
SIGNIFICANCE = 0.05
Z_95 = 1.96
SEED = 42


def segment_pairs(assignments: DataFrame, old_segments: DataFrame) -> DataFrame:
    """V1: new and old segment of each customer that has both."""
    new = assignments.withColumnRenamed("segment_name", "segment_name_new")
    old = old_segments.select(
        "customer_id", "old_segment_id", F.col("segment_name").alias("segment_name_old")
    )
    return new.join(old, "customer_id")


def holdout_group(customer_id: Column, seed: int = SEED) -> Column:
    """V2: treatment or control by a hash of the id, the same on every run and engine."""
    digest = F.substring(F.md5(F.concat(customer_id, F.lit(f":{seed}"))), 1, 8)
    return F.when(digest < "80000000", "treatment").otherwise("control")


def split_holdout(customers: DataFrame, seed: int = SEED, exact: bool = False) -> DataFrame:
    """V2: add ``test_group``.

    ``exact`` puts floor(n/2) customers into treatment: those with the smallest hashes,
    found by their rank without sorting the customers.
    """
    if not exact:
        return customers.withColumn("test_group", holdout_group(F.col("customer_id"), seed))
    digest = F.md5(F.concat(F.col("customer_id"), F.lit(f":{seed}")))
    # 52 bits stay exact as a double.
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    hashed = customers.withColumn("_hash", number)
    last = value_at_rank(hashed, [], "_hash", F.floor(F.col("n") / F.lit(2.0)), "last").scalar()
    treated = F.coalesce(F.col("_hash") <= last, F.lit(False))
    return hashed.withColumn(
        "test_group", F.when(treated, "treatment").otherwise("control")
    ).drop("_hash")


def holdout_results(
    campaigns: DataFrame, assignments: DataFrame, old_segments: DataFrame, seed: int = SEED
) -> DataFrame:
    """V3: campaign outcomes with group and the segment that was used for targeting.

    Control was targeted by the old segment, treatment by the new one.
    """
    pairs = segment_pairs(assignments, old_segments)
    treated = F.col("test_group") == "treatment"
    return (
        campaigns.join(split_holdout(pairs, seed), "customer_id")
        .withColumn(
            "segment_used",
            F.when(treated, F.col("segment_name_new")).otherwise(F.col("segment_name_old")),
        )
        .select(
            "campaign_id",
            "campaign_name",
            F.col("channel").alias("campaign_channel"),
            F.col("send_date").cast("date").alias("send_date"),
            "customer_id",
            "test_group",
            "segment_used",
            F.col("segment_name_new").alias("new_segment"),
            *OUTCOMES,
            "revenue",
        )
    )


def per_customer_results(holdout: DataFrame) -> DataFrame:
    """One row per customer with mean outcomes, for tests that count each customer once.

    Several waves send to the same customers; the tests below count each send.
    """
    return holdout.groupBy("customer_id", "test_group", "new_segment").agg(
        *[F.avg(c).alias(c) for c in (*OUTCOMES, "revenue")]
    )


def _of(group: str, value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.when(F.col("test_group") == group, column)


def lift_percent(treatment: Column, control: Column) -> Column:
    """Relative gain in percent, zero where control is zero."""
    return F.when(control > 0, (treatment - control) / control * 100).otherwise(
        F.when(control.isNotNull(), F.lit(0.0))
    )


def _outcome_rows(holdout: DataFrame) -> DataFrame:
    """One row per outcome with size, successes and rate of both groups, from one pass."""
    groups = ("control", "treatment")
    stats = holdout.agg(
        *[F.count(_of(group, F.lit(1))).alias(f"{group}_n") for group in groups],
        *[
            aggregate(_of(group, outcome)).alias(f"{outcome}_{group}_{name}")
            for outcome in OUTCOMES
            for group in groups
            for name, aggregate in (("successes", F.sum), ("rate", F.avg))
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(outcome).alias("metric"),
                *[
                    F.col(f"{outcome}_{group}_{name}").alias(f"{group}_{name}")
                    for group in groups
                    for name in ("successes", "rate")
                ],
            )
            for outcome in OUTCOMES
        ]
    )
    return stats.select("control_n", "treatment_n", F.inline(rows))


def rates_and_lift(holdout: DataFrame) -> DataFrame:
    """V4: rate per group and relative lift for each outcome."""
    return _outcome_rows(holdout).select(
        "metric",
        "control_rate",
        "treatment_rate",
        lift_percent(F.col("treatment_rate"), F.col("control_rate")).alias("lift_pct"),
    )


def proportion_tests(holdout: DataFrame, level: float = SIGNIFICANCE) -> DataFrame:
    """V5, V8: two-proportion z-test with pooled variance per outcome."""
    n_c, n_t = F.col("control_n"), F.col("treatment_n")
    pooled = F.try_divide(F.col("control_successes") + F.col("treatment_successes"), n_c + n_t)
    # 1/n_c + 1/n_t as one quotient
    spread = F.try_divide((n_c + n_t).cast("double"), n_c * n_t)
    compared = _outcome_rows(holdout).select(
        "metric",
        (F.col("treatment_rate") - F.col("control_rate")).alias("gap"),
        F.sqrt(pooled * (1 - pooled) * spread).alias("error"),
    )
    z = F.when(F.col("error") == 0, F.lit(0.0)).otherwise(F.try_divide("gap", "error"))
    tested = compared.select("metric", z.alias("z"))
    return tested.withColumn("p_value", normal_two_sided(F.col("z"))).withColumn(
        "significant", F.col("p_value") < level
    )


def revenue_test(holdout: DataFrame, level: float = SIGNIFICANCE) -> DataFrame:
    """V6, V8: revenue per send, lift and the t-test with equal variances.

    Without any spread in either group there is no statistic; t and p are null then.
    """
    stats = holdout.agg(
        *[
            aggregate(_of(group, "revenue")).alias(f"{group}_{name}")
            for group in ("control", "treatment")
            for name, aggregate in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
        ]
    )
    n_c, n_t = F.col("control_n"), F.col("treatment_n")
    freedom = n_c + n_t - 2
    pooled = F.try_divide(
        (n_c - 1) * F.col("control_var") + (n_t - 1) * F.col("treatment_var"), freedom
    )
    error = F.sqrt(
        pooled * (F.try_divide(F.lit(1.0), n_c) + F.try_divide(F.lit(1.0), n_t))
    )
    gap = F.col("treatment_mean") - F.col("control_mean")
    tested = stats.select(
        F.col("control_mean").alias("control_revenue_per_send"),
        F.col("treatment_mean").alias("treatment_revenue_per_send"),
        lift_percent(F.col("treatment_mean"), F.col("control_mean")).alias("lift_pct"),
        F.try_divide(gap, error).alias("t"),
        freedom.alias("degrees_of_freedom"),
    )
    return tested.withColumn(
        "p_value", student_two_sided(F.col("t"), F.col("degrees_of_freedom"))
    ).withColumn("significant", F.col("p_value") < level)


def conversion_interval(holdout: DataFrame) -> DataFrame:
    """V7: conversion lift with its 95 % interval, relative to control."""
    rows = _outcome_rows(holdout).where(F.col("metric") == "converted")
    control, treatment = F.col("control_rate"), F.col("treatment_rate")
    variance = F.try_divide(treatment * (1 - treatment), F.col("treatment_n")) + F.try_divide(
        control * (1 - control), F.col("control_n")
    )
    margin = F.lit(Z_95) * F.sqrt(variance)
    gap = treatment - control

    def relative(value: Column) -> Column:
        return F.when(control > 0, value / control * 100).otherwise(
            F.when(control.isNotNull(), F.lit(0.0))
        )

    return rows.select(
        "control_rate",
        "treatment_rate",
        relative(gap).alias("lift_pct"),
        relative(gap - margin).alias("ci_lower_pct"),
        relative(gap + margin).alias("ci_upper_pct"),
    )


def treatment_by_segment(holdout: DataFrame) -> DataFrame:
    """V9: treatment results per new segment against the mean conversion of control."""
    baseline = (
        holdout.where(F.col("test_group") == "control").agg(F.avg("converted")).scalar()
    )
    segments = (
        holdout.where(F.col("test_group") == "treatment")
        .groupBy("new_segment")
        .agg(
            F.count("*").alias("n"),
            F.avg("opened").alias("open_rate"),
            F.avg("clicked").alias("click_rate"),
            F.avg("converted").alias("conversion_rate"),
            F.avg("revenue").alias("revenue_per_send"),
        )
    )
    return (
        segments.withColumn("control_conversion", baseline)
        .withColumn(
            "lift_pct", lift_percent(F.col("conversion_rate"), F.col("control_conversion"))
        )
        .orderBy("new_segment")
    )


def group_sizes(holdout: DataFrame) -> DataFrame:
    """Rows per group."""
    return holdout.groupBy("test_group").agg(F.count("*").alias("records"))
