"""Behavioural features per customer (R1-R13, features F-1 to F-28).

Plan shape. Transactions are first summed up per customer, category and day. That
aggregate combines on the map side and spreads a very active customer over many
tasks; its result holds at most days x categories rows per customer. Everything
but the median follows from it after one more shuffle on ``customer_id``: the span
of a customer's history, the counts on both sides of its midpoint, the distinct
categories. The reference date enters as a scalar subquery.

The features can be built for several dates in one pass (``days_back``): the rows
are shuffled once and only then repeated per date. ``keys`` names what identifies a
result row, ``customer_id`` for one date and ``as_of, customer_id`` for several; with
one date every join below reuses the shuffle on ``customer_id``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.constants import (
    DEEP_SESSION_EVENTS,
    LONG_WINDOW_DAYS,
    LONG_WINDOW_QUARTERS,
    LOYALTY_TIERS,
    MAINTENANCE_CATEGORIES,
    MIN_TRANSACTIONS,
    PROJECT_CATEGORIES,
    SHORT_WINDOW_DAYS,
)
from basketlens.functions.numeric import is_false, is_true, ratio, round_to
from basketlens.functions.ranks import discrete_median, in_cents, value_at_rank
from basketlens.sources.schemas import SCHEMAS

CUSTOMER = ("customer_id",)
CUSTOMER_AT_DATE = ("as_of", "customer_id")
#: So many rows a task repeats, sorts and sums up for several dates (some hundred bytes each).
ROWS_PER_TASK = 1 << 16
#: Up to so many partitions a shuffle writes rows as they come and holds none (Spark's default
#: of spark.shuffle.sort.bypassMergeThreshold).
UNBUFFERED_PARTITIONS = 200

WEB_COLUMNS = (
    "total_sessions",
    "avg_pages_per_session",
    "search_rate",
    "product_page_ratio",
    "cart_page_ratio",
    "mobile_ratio",
    "deep_browse_ratio",
)


def _not_after(date: Column, limit: Column) -> Column:
    """Rows without a date are kept, as they are when no date limits the history."""
    return F.coalesce(date <= limit, F.lit(True))


def window_length(ref_date: Column) -> Column:
    return F.when(
        F.quarter(ref_date).isin(*LONG_WINDOW_QUARTERS), F.lit(LONG_WINDOW_DAYS)
    ).otherwise(F.lit(SHORT_WINDOW_DAYS))


def reference_windows(
    transactions: DataFrame, as_of: dt.date | None = None, days_back: Sequence[int] = (0,)
) -> DataFrame:
    """Per snapshot its date, the newest transaction up to it and the window length.

    Snapshots lie ``days_back`` days before ``as_of``, by default the newest date in
    the data.
    """
    date = F.col("transaction_date")
    if as_of is not None:
        transactions = transactions.where(date <= F.lit(as_of))
    if tuple(days_back) == (0,):
        dates = transactions.agg(F.max(date).alias("ref_date"))
        dates = dates.select(F.coalesce(F.lit(as_of), "ref_date").alias("as_of"), "ref_date")
    else:
        # The days that occur fit into one row, so one pass serves every snapshot.
        days = transactions.agg(F.collect_set(date).alias("days"))
        newest = F.coalesce(F.lit(as_of), F.array_max("days"))
        limits = F.array(*[F.date_sub(newest, n) for n in days_back])
        dates = days.select("days", F.explode(limits).alias("as_of")).select(
            "as_of", F.array_max(F.filter("days", lambda d: d <= F.col("as_of"))).alias("ref_date")
        )
    return dates.select("as_of", "ref_date", window_length(F.col("ref_date")).alias("window_days"))


def _snapshot_array(windows: DataFrame) -> Column:
    """All snapshots as one array value, from a scalar subquery; a row per refresh date."""
    return windows.agg(
        F.array_sort(F.collect_list(F.struct("as_of", "ref_date", "window_days")))
    ).scalar()


def _by_customer(df: DataFrame, rows: int) -> DataFrame:
    """Shuffle by customer, into as many partitions as ``rows`` need at ROWS_PER_TASK each.

    Left to itself Spark makes partitions by their bytes in the shuffle, which are a small
    part of what rows take once they are repeated per date.
    """
    needed = -(-rows // ROWS_PER_TASK)
    if needed <= 1:
        return df.repartition("customer_id")
    return df.repartition(max(needed, df.sparkSession.sparkContext.defaultParallelism), "customer_id")


def _by_summed_keys(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Shuffle by what ``rows`` rows are summed up by, if a task should not hold the sums of all.

    A sum before the shuffle holds a group for nearly every row of a task's input split, which
    grows with the tables; here a task gets a 200th of the rows at most, and customers of any
    size are spread by the other keys.
    """
    needed = -(-rows // ROWS_PER_TASK)
    if needed <= 1:
        return df
    parallel = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(min(max(needed, parallel), UNBUFFERED_PARTITIONS), *keys)


def _per_snapshot(df: DataFrame, windows: DataFrame, date: str) -> DataFrame:
    """Repeat each row for the snapshots it already belongs to."""
    snapshot = F.explode(_snapshot_array(windows)).alias("_s")
    return (
        df.select("*", snapshot)
        .where(_not_after(F.col(date), F.col("_s.as_of")))
        .select(*df.columns, "_s.as_of", "_s.ref_date", "_s.window_days")
    )


def eligible_customers(
    transactions: DataFrame, min_transactions: int = MIN_TRANSACTIONS
) -> DataFrame:
    """Customers with enough transactions to be described."""
    return (
        transactions.groupBy("customer_id")
        .agg(F.count("*").alias("total_txn_count"))
        .where(F.col("total_txn_count") >= min_transactions)
    )


def daily_purchases(transactions: DataFrame, rows: int = 0) -> DataFrame:
    """Transactions, of which there are ``rows`` if known, summed up per customer, category and day."""
    promo = is_true("promo_flag")
    keys = ("customer_id", "category", "transaction_date")
    summed = transactions.select(*keys, "amount", "channel", "promo_flag", "discount_pct")
    return _by_summed_keys(summed, rows, *keys).groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count("amount").alias("amounts"),
        F.sum("amount").alias("amount"),
        F.count_if(F.col("channel") == "online").alias("online"),
        F.count_if(promo).alias("promo"),
        F.count_if(is_false("promo_flag")).alias("full_price"),
        F.sum(F.when(promo, F.col("discount_pct")).otherwise(F.lit(0.0))).alias("discount"),
    )


def purchase_features(
    transactions: DataFrame,
    windows: DataFrame,
    keys: Sequence[str] = CUSTOMER,
    min_transactions: int = MIN_TRANSACTIONS,
    project_categories: Sequence[str] = PROJECT_CATEGORIES,
    maintenance_categories: Sequence[str] = MAINTENANCE_CATEGORIES,
) -> DataFrame:
    """R4-R7 without the median: one row per date and eligible customer."""
    return purchase_features_of_days(
        daily_purchases(transactions), windows, keys, min_transactions, project_categories, maintenance_categories
    )


def purchase_features_of_days(
    days: DataFrame,
    windows: DataFrame,
    keys: Sequence[str] = CUSTOMER,
    min_transactions: int = MIN_TRANSACTIONS,
    project_categories: Sequence[str] = PROJECT_CATEGORIES,
    maintenance_categories: Sequence[str] = MAINTENANCE_CATEGORIES,
    rows: int = 0,
) -> DataFrame:
    """R4-R7 without the median, from :func:`daily_purchases`, of which there are at most ``rows`` if known."""
    days = _per_snapshot(_by_customer(days, rows), windows, "transaction_date")
    date = F.col("transaction_date")
    history = Window.partitionBy(*keys)
    days = days.withColumns(
        {"first_date": F.min(date).over(history), "last_date": F.max(date).over(history)}
    )
    # Half a day rounds up: the span's half is rounded, not cut.
    half_span = F.round(F.datediff("last_date", "first_date") / F.lit(2.0)).cast("int")
    midpoint = F.date_add("first_date", half_span)
    in_window = date >= F.date_sub("ref_date", F.col("window_days"))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("rows")).otherwise(F.lit(0)))

    constant = [c for c in (*windows.columns, "first_date", "last_date") if c not in keys]
    categories = days.groupBy(*keys, "category").agg(
        *[
            F.sum(c).alias(c)
            for c in ("rows", "amounts", "amount", "online", "promo", "full_price", "discount")
        ],
        rows_where(in_window).alias("in_window"),
        rows_where(date >= midpoint).alias("late"),
        rows_where(date < midpoint).alias("early"),
        rows_where(F.quarter(date) == 2).alias("second_quarter"),
        rows_where(F.dayofweek(date).isin(1, 7)).alias("weekend"),
        *[F.first(c).alias(c) for c in constant],
    )
    is_project = F.col("category").isin(*project_categories)
    is_maintenance = F.col("category").isin(*maintenance_categories)
    summed = (
        "rows amounts amount online promo full_price discount in_window late early "
        "second_quarter weekend"
    ).split()
    customers = (
        categories.groupBy(*keys)
        .agg(
            *[F.sum(c).alias(c) for c in summed],
            F.count("category").alias("category_breadth"),
            rows_where(is_project).alias("project_rows"),
            rows_where(is_maintenance).alias("maintenance_rows"),
            F.count_if(is_project & (F.col("in_window") > 0)).alias("project_categories"),
            *[F.first(c).alias(c) for c in constant],
        )
        .where(F.col("rows") >= min_transactions)
    )
    rows = F.col("rows")
    months = F.greatest(F.datediff("last_date", "first_date") / F.lit(30.0), F.lit(1.0))
    return customers.select(
        "as_of",
        "customer_id",
        rows.alias("total_transactions"),
        F.col("in_window").alias("txns_in_window"),
        round_to(F.col("in_window") / (F.col("window_days") / F.lit(7.0)), 2).alias(
            "weekly_purchase_frequency"
        ),
        "category_breadth",
        round_to(F.try_divide("amount", "amounts"), 2).alias("avg_basket_size"),
        ratio(F.col("online"), rows, 4).alias("online_ratio"),
        F.col("project_rows").alias("project_category_txns"),
        F.col("maintenance_rows").alias("maintenance_category_txns"),
        ratio(F.col("project_rows"), rows, 4).alias("project_ratio"),
        F.col("project_categories").alias("project_categories_in_window"),
        F.when(F.col("project_categories") >= 2, 1).otherwise(0).alias("is_project_buyer"),
        ratio(F.col("promo"), rows, 4).alias("promo_purchase_ratio"),
        ratio(F.col("discount"), F.col("promo"), 4).alias("avg_discount_depth"),
        ratio(F.col("full_price"), rows, 4).alias("full_price_ratio"),
        F.datediff("ref_date", "last_date").alias("days_since_last_purchase"),
        round_to(rows / months, 2).alias("monthly_frequency"),
        round_to(ratio(F.col("late"), F.col("early")) - F.lit(1.0), 4).alias("frequency_trend"),
        ratio(F.col("second_quarter"), rows, 4).alias("q2_concentration"),
        ratio(F.col("weekend"), rows, 4).alias("weekend_ratio"),
    )


def median_baskets(
    transactions: DataFrame,
    windows: DataFrame | None = None,
    keys: Sequence[str] = CUSTOMER,
    snapshots: int = 1,
) -> DataFrame:
    """F-6: the middle amount of each customer, an observed value, in whole cents.

    Without ``windows`` all transactions count. ``snapshots`` is the number of its dates.
    """
    rows = transactions.select("customer_id", "transaction_date", in_cents("amount").alias("cents"))
    if len(keys) == 1:
        if windows is not None:
            limit = windows.select("as_of").scalar()
            rows = rows.where(_not_after(F.col("transaction_date"), limit))
        # One aggregate combined on the map side; a customer has a count per different amount.
        medians = rows.groupBy(*keys).agg(discrete_median("cents").alias("median"))
    else:
        # A median per snapshot, each over the rows up to its date, instead of rows per snapshot.
        dates = [f"date_{i}" for i in range(snapshots)]
        rows = rows.withColumn("snapshots", _snapshot_array(windows)).select(
            "customer_id",
            *[
                F.when(_not_after(F.col("transaction_date"), F.col("snapshots")[i]["as_of"]), F.col("cents")).alias(name)
                for i, name in enumerate(dates)
            ],
        )
        wide = rows.groupBy("customer_id").agg(*[discrete_median(name).alias(name) for name in dates])
        wide = wide.withColumn("snapshots", _snapshot_array(windows))
        per_date = F.array(
            *[F.struct(F.col("snapshots")[i]["as_of"].alias("as_of"), F.col(name).alias("median")) for i, name in enumerate(dates)]
        )
        medians = wide.select("customer_id", F.inline(per_date)).where("median IS NOT NULL")
    return medians.select(*keys, (F.col("median") / F.lit(100.0)).alias("median_basket_size"))


def daily_cents(transactions: DataFrame) -> DataFrame:
    """How often a customer paid an amount on a day, which is what medians need."""
    amount = in_cents("amount").alias("cents")
    return (
        transactions.where("amount IS NOT NULL")
        .groupBy("customer_id", "transaction_date", amount)
        .agg(F.count("*").alias("rows"))
    )


def median_baskets_of_days(
    cents: DataFrame, windows: DataFrame | None = None, keys: Sequence[str] = CUSTOMER
) -> DataFrame:
    """F-6 from :func:`daily_cents`: one round over a customer's different amounts."""
    if windows is not None:
        cents = _per_snapshot(cents, windows, "transaction_date")
    middle = F.ceil(F.col("n") / F.lit(2.0))
    medians = value_at_rank(cents, list(keys), "cents", middle, "median", "rows", rounds=(0,))
    return medians.select(*keys, (F.col("median") / F.lit(100.0)).alias("median_basket_size"))


SESSION_SUMS = ("page_count", "searches", "product_pages", "cart_pages", "mobile_pages")


def session_stats(web_events: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Events per session, with the counts the page shares need."""
    return web_events.groupBy(*extra_keys, "session_id", "customer_id").agg(
        F.count("*").alias("page_count"),
        F.sum("search_flag").alias("searches"),
        F.count_if(F.col("page_type") == "product").alias("product_pages"),
        F.count_if(F.col("page_type") == "cart").alias("cart_pages"),
        F.count_if(F.col("device") == "mobile").alias("mobile_pages"),
    )


def daily_sessions(web_events: DataFrame, rows: int = 0) -> DataFrame:
    """Web events, of which there are ``rows`` if known, summed up per customer, session and day."""
    keys = ("event_date", "session_id", "customer_id")
    summed = web_events.select(*keys, "search_flag", "page_type", "device")
    return session_stats(_by_summed_keys(summed, rows, *keys), ["event_date"])


def web_features(
    web_events: DataFrame,
    windows: DataFrame | None = None,
    keys: Sequence[str] = CUSTOMER,
    deep_session: int = DEEP_SESSION_EVENTS,
    rows: int = 0,
) -> DataFrame:
    """Browsing per customer, in one pass over the sessions.

    With ``windows`` the features are built per date from the events up to it; without,
    from all events.
    """
    if windows is not None:
        return web_features_of_days(daily_sessions(web_events, rows), windows, keys, deep_session, rows)
    return _web_totals(session_stats(web_events), keys, deep_session)


def web_features_of_days(
    days: DataFrame,
    windows: DataFrame,
    keys: Sequence[str] = CUSTOMER,
    deep_session: int = DEEP_SESSION_EVENTS,
    rows: int = 0,
) -> DataFrame:
    """R9, R10 at the dates of ``windows``, from :func:`daily_sessions`, at most ``rows`` if known.

    The days of a session are what is repeated per date, after their shuffle by customer,
    which the sums per session and per customer use as well.
    """
    days = _per_snapshot(_by_customer(days, rows), windows, "event_date")
    session = [*[key for key in keys if key != "customer_id"], "session_id", "customer_id"]
    sessions = days.groupBy(*session).agg(*[F.sum(c).alias(c) for c in SESSION_SUMS])
    return _web_totals(sessions, keys, deep_session)


def web_features_of_all_days(days: DataFrame) -> DataFrame:
    """R9, R10 over the whole of :func:`daily_sessions`."""
    sessions = days.groupBy("session_id", "customer_id").agg(*[F.sum(c).alias(c) for c in SESSION_SUMS])
    return _web_totals(sessions, CUSTOMER, DEEP_SESSION_EVENTS)


def _web_totals(sessions: DataFrame, keys: Sequence[str], deep_session: int) -> DataFrame:
    totals = sessions.groupBy(*keys).agg(
        # One row per session already; an unknown session id is no session.
        F.count("session_id").alias("total_sessions"),
        F.count_if(F.col("page_count") >= deep_session).alias("deep"),
        *[F.sum(c).alias(c) for c in SESSION_SUMS],
    )
    count = F.col("total_sessions")
    events = F.col("page_count")
    return totals.select(
        *keys,
        "total_sessions",
        ratio(events, count, 2).alias("avg_pages_per_session"),
        ratio(F.col("searches"), F.greatest(count, F.lit(1)), 4).alias("search_rate"),
        ratio(F.col("product_pages"), events, 4).alias("product_page_ratio"),
        ratio(F.col("cart_pages"), events, 4).alias("cart_page_ratio"),
        ratio(F.col("mobile_pages"), events, 4).alias("mobile_ratio"),
        ratio(F.col("deep"), count, 4).alias("deep_browse_ratio"),
    )


def loyalty_features(loyalty: DataFrame) -> DataFrame:
    """Tier as a number and points."""
    tier = F.lit(0)
    for name, level in LOYALTY_TIERS.items():
        tier = F.when(F.col("loyalty_tier") == name, level).otherwise(tier)
    return loyalty.select("customer_id", tier.alias("loyalty_tier_numeric"), "points_balance")


def customer_regions(customer_master: DataFrame) -> DataFrame:
    """Region per customer, context only."""
    return customer_master.select("customer_id", "region")


def only_eligible(df: DataFrame, eligible: DataFrame) -> DataFrame:
    """Keep the rows of eligible customers."""
    return df.join(eligible.select("customer_id"), "customer_id", "left_semi")


def snapshot_features(
    tables: dict[str, DataFrame],
    as_of: dt.date | None = None,
    days_back: Sequence[int] = (0,),
    min_transactions: int = MIN_TRANSACTIONS,
    trim_web: bool = False,
    project_categories: Sequence[str] = PROJECT_CATEGORIES,
    maintenance_categories: Sequence[str] = MAINTENANCE_CATEGORIES,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """R13 at one or several dates: the 28 features with ``as_of`` in front.

    ``trim_web`` also leaves out web events after the snapshot's date, for a history
    rebuilt later from a table that has gone on growing. ``columns`` names the features
    that are wanted, besides the customer; medians, browsing and loyalty are only built
    for them. The rows are the same for any choice.

    Where ``tables`` has the results of :func:`daily_purchases`, :func:`daily_cents` and
    :func:`daily_sessions` under these names, they are read instead of the single rows.
    """
    fields = SCHEMAS["customer_features"].fields
    if columns is not None:
        unknown = set(columns) - {f.name for f in fields}
        if unknown:
            raise ValueError(f"unknown features: {', '.join(sorted(unknown))}")
        fields = [f for f in fields if f.name == "customer_id" or f.name in columns]
    wanted = {f.name for f in fields}
    stored = "daily_purchases" in tables
    windows = reference_windows(
        tables["daily_purchases" if stored else "transactions"], as_of, days_back
    )
    keys = CUSTOMER if len(days_back) == 1 else CUSTOMER_AT_DATE
    whole_history = as_of is None and tuple(days_back) == (0,)
    web_keys = keys if trim_web else CUSTOMER
    rows = 0
    if len(days_back) > 1:
        # Both sides get the same number of partitions, so that their join moves neither.
        sources = ["daily_purchases" if stored else "transactions"]
        if trim_web and wanted & set(WEB_COLUMNS):
            sources.append("daily_sessions" if stored else "web_events")
        rows = max(tables[name].count() for name in sources)
    purchases = tables["daily_purchases"] if stored else daily_purchases(tables["transactions"], rows)
    joined = purchase_features_of_days(
        purchases,
        windows,
        keys,
        min_transactions,
        project_categories,
        maintenance_categories,
        rows,
    )
    # Joins on the customer alone come first, while the rows lie by customer.
    if wanted & {"loyalty_tier_numeric", "points_balance"}:
        joined = joined.join(loyalty_features(tables["loyalty"]), "customer_id", "left")
    joined = joined.join(customer_regions(tables["customer_master"]), "customer_id")
    if wanted & set(WEB_COLUMNS):
        if stored and trim_web:
            web = web_features_of_days(tables["daily_sessions"], windows, web_keys, rows=rows)
        elif stored:
            web = web_features_of_all_days(tables["daily_sessions"])
        else:
            web = web_features(tables["web_events"], windows if trim_web else None, web_keys, rows=rows)
        joined = joined.join(web, list(web_keys), "left")
    if "median_basket_size" in wanted:
        limits = None if whole_history else windows
        if stored:
            medians = median_baskets_of_days(tables["daily_cents"], limits, keys)
        else:
            medians = median_baskets(tables["transactions"], limits, keys, len(days_back))
        joined = joined.join(medians, list(keys), "left")
    zero_filled = (*WEB_COLUMNS, "loyalty_tier_numeric", "points_balance")
    return joined.select(
        "as_of",
        *[
            (F.coalesce(F.col(f.name), F.lit(0)) if f.name in zero_filled else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in fields
        ],
    )


def customer_features(
    tables: dict[str, DataFrame],
    as_of: dt.date | None = None,
    ordered: bool = False,
    **options: object,
) -> DataFrame:
    """One row per eligible customer with a master row.

    ``ordered`` sorts by customer, which is a further shuffle and of use only to a
    reader of the rows; a table is better clustered by its writer.
    """
    features = snapshot_features(tables, as_of, **options).drop("as_of")
    return features.orderBy("customer_id") if ordered else features
