"""The weekly history against features built for each date alone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from basketlens.operators.features import customer_features
from basketlens.plans.segmentation import feature_history
from basketlens.sources.sample_views import sample_tables

DATA = "/root/testdata/sf0.001"


def test_history_equals_features_of_each_date(spark):
    tables = sample_tables(spark, DATA)
    newest = tables["transactions"].agg(F.max("transaction_date")).first()[0]
    history = feature_history(tables, weeks=3)
    by_week = {}
    for row in history.collect():
        values = row.asDict()
        by_week.setdefault(values.pop("week"), []).append(str(sorted(values.items())))
    assert sorted(by_week) == [0, 1, 2, 3]
    for week in range(4):
        date = newest - dt.timedelta(days=7 * (3 - week))
        alone = customer_features(tables, date, trim_web=True).collect()
        assert sorted(by_week[week]) == sorted(str(sorted(r.asDict().items())) for r in alone)


def test_history_bounds_the_rows_of_a_task(spark, monkeypatch):
    """A task that repeats rows per date gets a bounded number of them, whatever the tables' size."""
    from basketlens.operators import features

    day = dt.date(2024, 1, 1)
    transactions = spark.createDataFrame(
        [
            (f"T{i}", f"C{i % 150}", day + dt.timedelta(days=i % 60), float(i % 90), "Paint", "online", i % 3 == 0, 0.1)
            for i in range(3000)
        ],
        "transaction_id string, customer_id string, transaction_date date, amount double, category string,"
        " channel string, promo_flag boolean, discount_pct double",
    )
    events = spark.createDataFrame(
        [(f"E{i}", f"C{i % 150}", f"S{i // 4}", day + dt.timedelta(days=i % 60), "cart", "mobile", i % 2) for i in range(2000)],
        "event_id string, customer_id string, session_id string, event_date date, page_type string, device string, search_flag long",
    )
    customers = spark.createDataFrame([(f"C{i}", "EAST") for i in range(150)], "customer_id string, region string")
    tables = {"transactions": transactions, "web_events": events, "customer_master": customers}
    columns = ("avg_basket_size", "frequency_trend", "total_sessions", "search_rate")

    def plan_and_rows(rows_per_task):
        monkeypatch.setattr(features, "ROWS_PER_TASK", rows_per_task, raising=False)
        history = feature_history(tables, columns=columns)
        return history._jdf.queryExecution().toString(), sorted(map(str, history.collect()))

    few, expected = plan_and_rows(1 << 16)
    many, found = plan_and_rows(100)
    assert "REPARTITION_BY_NUM" not in few
    assert "hashpartitioning(customer_id" in many and many.count(", 30), REPARTITION_BY_NUM") >= 2
    assert len(expected) > 500 and found == expected


def test_history_sums_rows_behind_the_shuffle(spark, monkeypatch):
    """No task sums up an input split of any size: groups are formed where rows are dealt by their keys."""
    from basketlens.operators import features

    day = dt.date(2024, 1, 1)
    transactions = spark.createDataFrame(
        [(f"C{i % 40}", day + dt.timedelta(days=i % 9), float(i % 90), "Paint" if i % 3 else None, "online", i % 2 == 0, 0.1) for i in range(900)],
        "customer_id string, transaction_date date, amount double, category string, channel string, promo_flag boolean, discount_pct double",
    )
    events = spark.createDataFrame(
        [(f"C{i % 40}", f"S{i // 4}", day + dt.timedelta(days=i % 9), "cart", "mobile", i % 2) for i in range(900)],
        "customer_id string, session_id string, event_date date, page_type string, device string, search_flag long",
    )
    expected = [sorted(map(str, f(rows).collect())) for f, rows in ((features.daily_purchases, transactions), (features.daily_sessions, events))]
    monkeypatch.setattr(features, "ROWS_PER_TASK", 2)
    found = [features.daily_purchases(transactions, 900), features.daily_sessions(events, 900)]
    for df, rows in zip(found, expected):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and ", 200), REPARTITION_BY_NUM" in plan
        assert plan.index("HashAggregate") < plan.index("Exchange") and "HashAggregate" not in plan[plan.index("Exchange"):]
        assert sorted(map(str, df.collect())) == rows
