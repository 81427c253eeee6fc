"""Profiles of the loaded tables.

Facts are summed up per customer before they meet a customer table. The join then
moves one row per customer and category at most, however many rows one customer has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.constants import MIN_TRANSACTIONS, POWER_USER_TRANSACTIONS
from basketlens.functions.numeric import is_true, percent, ratio, round_to, with_share
from basketlens.functions.ranks import in_cents, join_groups, lower_median


def table_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, by name."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def transactions_profile(transactions: DataFrame) -> DataFrame:
    """One row about all transactions.

    ``avg_discount_when_promo`` averages all rows, those without promotion as well;
    ``avg_discount_promo_only`` is the figure its name promises.
    """
    promo = is_true("promo_flag")
    cents = transactions.select(in_cents("amount").alias("cents"))
    median = lower_median(cents, [], "cents", "median_amount").scalar() / F.lit(100.0)
    profile = transactions.agg(
        F.min("transaction_date").alias("earliest_txn"),
        F.max("transaction_date").alias("latest_txn"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count("*").alias("total_txns"),
        F.avg("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.count_if(F.col("channel") == "online").alias("online"),
        F.count_if(promo).alias("promo"),
        F.avg("discount_pct").alias("avg_discount"),
        F.avg(F.when(promo, F.col("discount_pct"))).alias("avg_promo_discount"),
    )
    return profile.select(
        "earliest_txn",
        "latest_txn",
        "unique_customers",
        "total_txns",
        round_to(F.col("avg_amount"), 2).alias("avg_amount"),
        round_to(median, 2).alias("median_amount"),
        round_to(F.col("min_amount"), 2).alias("min_amount"),
        round_to(F.col("max_amount"), 2).alias("max_amount"),
        percent(F.col("online"), F.col("total_txns"), 1).alias("online_pct"),
        percent(F.col("promo"), F.col("total_txns"), 1).alias("promo_pct"),
        round_to(F.col("avg_discount") * 100, 1).alias("avg_discount_when_promo"),
        round_to(F.col("avg_promo_discount") * 100, 1).alias("avg_discount_promo_only"),
    )


def category_distribution(transactions: DataFrame) -> DataFrame:
    """Transactions, share, mean amount and customers per category, largest first."""
    groups = transactions.groupBy("category").agg(
        F.count("*").alias("txn_count"),
        F.avg("amount").alias("avg_amount"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return (
        with_share(groups, "txn_count", "pct_of_txns")
        .select(
            "category",
            "txn_count",
            "pct_of_txns",
            round_to(F.col("avg_amount"), 2).alias("avg_amount"),
            "unique_customers",
        )
        .orderBy(F.desc("txn_count"), "category")
    )


def transactions_per_customer(
    transactions: DataFrame,
    below: int = MIN_TRANSACTIONS,
    power_user: int = POWER_USER_TRANSACTIONS,
) -> DataFrame:
    """How the number of transactions is distributed over customers."""
    counts = transactions.groupBy("customer_id").agg(F.count("*").alias("txn_count"))
    median = lower_median(counts, [], "txn_count", "median_txns")
    summary = counts.agg(
        F.avg("txn_count").alias("mean"),
        F.min("txn_count").alias("min_txns"),
        F.max("txn_count").alias("max_txns"),
        F.count_if(F.col("txn_count") < below).alias("customers_below_3_txns"),
        F.count_if(F.col("txn_count") >= power_user).alias("power_users"),
    )
    return summary.select(
        round_to(F.col("mean"), 1).alias("avg_txns_per_customer"),
        round_to(median.scalar(), 1).alias("median_txns"),
        "min_txns",
        "max_txns",
        "customers_below_3_txns",
        "power_users",
    )


def old_segment_sizes(old_segments: DataFrame) -> DataFrame:
    """E5: customers and share per old segment."""
    groups = old_segments.groupBy("old_segment_id", "segment_name", "assignment_date").agg(
        F.count("*").alias("customer_count")
    )
    return (
        with_share(groups, "customer_count", "pct_of_total")
        .select(
            "old_segment_id", "segment_name", "customer_count", "pct_of_total", "assignment_date"
        )
        .orderBy("old_segment_id")
    )


def old_segment_behavior(old_segments: DataFrame, transactions: DataFrame) -> DataFrame:
    """Purchase behaviour per old segment.

    Sums, customers and categories come from one row per customer and category, so
    the two distinct counts expand only those. The distinct transaction ids need the
    single rows; the median needs them counted by cents, and its rounds read the counts.
    """
    keys = ["old_segment_id", "segment_name"]
    segments = old_segments.select("customer_id", *keys)
    per_category = transactions.groupBy("customer_id", "category").agg(
        F.count("*").alias("rows"),
        F.count("amount").alias("amounts"),
        F.sum("amount").alias("amount"),
        F.count_if(F.col("channel") == "online").alias("online"),
        F.count_if(is_true("promo_flag")).alias("promo"),
    )
    sums = (
        segments.join(per_category, "customer_id")
        .groupBy(*keys)
        .agg(
            *[F.sum(c).alias(c) for c in ("rows", "amounts", "amount", "online", "promo")],
            F.count_distinct("customer_id").alias("customers"),
            F.count_distinct("category").alias("distinct_categories"),
        )
    )
    rows = segments.join(transactions, "customer_id")
    ids = rows.groupBy(*keys).agg(F.count_distinct("transaction_id").alias("total_txns"))
    cents = rows.select(*keys, in_cents("amount").alias("cents"))
    medians = lower_median(cents, keys, "cents", "median")
    joined = join_groups(join_groups(sums, ids, keys, "left"), medians, keys, "left")
    return joined.select(
        *keys,
        "total_txns",
        "customers",
        round_to(F.try_divide("amount", "amounts"), 2).alias("avg_basket"),
        round_to(F.col("median") / F.lit(100.0), 2).alias("median_basket"),
        ratio(F.col("total_txns"), F.col("customers"), 1).alias("avg_txns_per_cust"),
        percent(F.col("online"), F.col("rows"), 1).alias("online_pct"),
        percent(F.col("promo"), F.col("rows"), 1).alias("promo_pct"),
        "distinct_categories",
    ).orderBy("old_segment_id")


def old_segment_campaigns(old_segments: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign response per old segment."""
    keys = ["old_segment_id", "segment_name"]
    outcomes = ("opened", "clicked", "converted")
    per_customer = campaigns.groupBy("customer_id").agg(
        F.count("*").alias("sends"),
        F.sum("revenue").alias("revenue"),
        *[F.sum(c).alias(c) for c in outcomes],
        *[F.count(c).alias(f"known_{c}") for c in outcomes],
    )
    totals = (
        per_customer.join(old_segments.select("customer_id", *keys), "customer_id")
        .groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in per_customer.columns if c != "customer_id"])
    )
    return totals.select(
        *keys,
        F.col("sends").alias("campaigns_sent"),
        percent(F.col("opened"), F.col("known_opened"), 1).alias("open_rate"),
        percent(F.col("clicked"), F.col("known_clicked"), 1).alias("click_rate"),
        percent(F.col("converted"), F.col("known_converted"), 1).alias("conversion_rate"),
        ratio(F.col("revenue"), F.col("sends"), 2).alias("revenue_per_send"),
    ).orderBy("old_segment_id")
