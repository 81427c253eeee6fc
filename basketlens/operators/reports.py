"""Reporting tables.

Transactions are summed up per customer before they meet the assignment, so the join
moves customers and not transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.constants import CHURN_COLUMNS, CHURN_RULES, LOW_RISK, PROFILE_COLUMNS, SUMMARY_COLUMNS
from basketlens.functions.numeric import ratio, round_to, with_share

SEGMENT = ("segment_id", "segment_name")


def customer_sales(transactions: DataFrame) -> DataFrame:
    """Sales per customer and quarter, all that X1 and X2 need of the transactions.

    As a table bucketed by customer it meets the assignments without a shuffle, and a customer
    with a third of all transactions has as few rows as others.
    """
    return _per_customer(
        transactions,
        F.year("transaction_date").alias("year"),
        F.quarter("transaction_date").alias("quarter"),
    )


def _per_customer(transactions: DataFrame, *periods: Column) -> DataFrame:
    return transactions.groupBy("customer_id", *periods).agg(
        F.count("transaction_id").alias("txns"),
        F.sum("amount").alias("revenue"),
        F.count("amount").alias("amounts"),
    )


def segment_health(
    assignments: DataFrame, transactions: DataFrame | None = None, sales: DataFrame | None = None
) -> DataFrame:
    """Customers, share, revenue and order value per segment.

    Customers without transactions are not counted. ``sales`` is a stored
    :func:`customer_sales` to read instead of the transactions.
    """
    if sales is None:
        sums = _per_customer(transactions)
    else:
        sums = sales.groupBy("customer_id").agg(*[F.sum(c).alias(c) for c in ("txns", "revenue", "amounts")])
    segments = (
        assignments.select("customer_id", *SEGMENT)
        .join(sums, "customer_id")
        .groupBy(*SEGMENT)
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            *[F.sum(c).alias(c) for c in ("txns", "revenue", "amounts")],
        )
    )
    customers = F.col("customer_count")
    return (
        with_share(segments, "customer_count", "pct_of_total")
        .select(
            *SEGMENT,
            "customer_count",
            "pct_of_total",
            round_to(F.col("revenue"), 2).alias("total_revenue"),
            ratio(F.col("revenue"), F.col("amounts"), 2).alias("avg_order_value"),
            ratio(F.col("revenue"), customers, 2).alias("revenue_per_customer"),
            ratio(F.col("txns"), customers, 1).alias("avg_txns_per_customer"),
        )
        .orderBy("segment_id")
    )


def segment_health_by_quarter(
    assignments: DataFrame, transactions: DataFrame | None = None, sales: DataFrame | None = None
) -> DataFrame:
    """Active customers, revenue and order value per segment and quarter."""
    sums = customer_sales(transactions) if sales is None else sales
    groups = (
        assignments.select("customer_id", *SEGMENT)
        .join(sums, "customer_id")
        .groupBy(*SEGMENT, "year", "quarter")
        .agg(
            F.count_distinct("customer_id").alias("active_customers"),
            F.sum("revenue").alias("revenue"),
            F.sum("amounts").alias("amounts"),
        )
    )
    return groups.select(
        *SEGMENT,
        "year",
        "quarter",
        F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string")).alias(
            "period"
        ),
        "active_customers",
        round_to(F.col("revenue"), 2).alias("period_revenue"),
        ratio(F.col("revenue"), F.col("amounts"), 2).alias("period_aov"),
    ).orderBy("year", "quarter", "segment_id")


def migration_report(log: DataFrame) -> DataFrame:
    """The migration log in order of weeks."""
    return log.orderBy("week")


def _response(sends: str) -> list[Column]:
    """Aggregates of campaign outcomes that X4 and X5 share."""
    return [
        F.count("*").alias(sends),
        round_to(F.avg("opened") * 100, 1).alias("open_rate"),
        round_to(F.avg("clicked") * 100, 1).alias("click_rate"),
        round_to(F.avg("converted") * 100, 1).alias("conversion_rate"),
        round_to(F.sum("revenue"), 2).alias("total_revenue"),
        round_to(F.sum("revenue") / F.count("*"), 2).alias("revenue_per_send"),
    ]


def campaign_performance(holdout: DataFrame) -> DataFrame:
    """Response per group, segment, campaign and channel."""
    return (
        holdout.withColumnRenamed("new_segment", "segment_name")
        .groupBy("test_group", "segment_name", "campaign_name", "campaign_channel")
        .agg(*_response("sends"))
        .orderBy("test_group", "segment_name", "campaign_name")
    )


def campaign_summary(holdout: DataFrame) -> DataFrame:
    """Response per group."""
    return holdout.groupBy("test_group").agg(*_response("total_sends"))


def _with_features(assignments: DataFrame, features: DataFrame) -> DataFrame:
    return assignments.select("customer_id", *SEGMENT).join(features, "customer_id")


def customer_profiles(assignments: DataFrame, features: DataFrame) -> DataFrame:
    """One row per customer with segment, features and region."""
    return (
        _with_features(assignments, features)
        .select(*SEGMENT, "customer_id", *PROFILE_COLUMNS)
        .orderBy("segment_id", "customer_id")
    )


def profile_summary(assignments: DataFrame, features: DataFrame) -> DataFrame:
    """Mean features per segment."""
    return (
        _with_features(assignments, features)
        .groupBy(*SEGMENT)
        .agg(
            F.count("*").alias("customer_count"),
            *[round_to(F.avg(c), digits).alias(name) for c, name, digits in SUMMARY_COLUMNS],
        )
        .orderBy("segment_id")
    )


def churn_risk() -> Column:
    """Risk by trend and absence; an unknown trend is judged by absence alone."""
    level = F.lit(LOW_RISK)
    for name, condition in reversed(CHURN_RULES):
        level = F.when(F.expr(condition), name).otherwise(level)
    return level


def churn_indicators(
    assignments: DataFrame, features: DataFrame, ordered: bool = True
) -> DataFrame:
    """Churn risk per customer, longest absence first."""
    report = _with_features(assignments, features).select(
        *SEGMENT,
        "customer_id",
        *CHURN_COLUMNS,
        churn_risk().alias("churn_risk_level"),
    )
    if not ordered:
        return report
    return report.orderBy(F.desc("days_since_last_purchase"), "customer_id")


def churn_summary(assignments: DataFrame, features: DataFrame) -> DataFrame:
    """Churn risk within each segment."""
    groups = (
        churn_indicators(assignments, features, ordered=False)
        .groupBy(*SEGMENT, "churn_risk_level")
        .agg(F.count("*").alias("customer_count"))
    )
    return with_share(
        groups, "customer_count", "pct_of_segment", within=["segment_name"]
    ).orderBy("segment_id", "churn_risk_level")
