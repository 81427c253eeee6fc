"""Edge cases of the features on hand-written rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.operators import features
from basketlens.sources.schemas import SCHEMAS
from basketlens.sources.tables import conform

D = dt.date


def transactions(spark, rows):
    """Rows of (customer, date, amount, category, channel, promo, discount)."""
    schema = (
        "customer_id string, transaction_date date, amount double, category string,"
        "channel string, promo_flag boolean, discount_pct double"
    )
    df = spark.createDataFrame(rows, schema)
    return conform(df.withColumn("transaction_id", F.uuid()), "transactions")


def tables(spark, rows, master=None, web=(), loyalty=()):
    customers = sorted({r[0] for r in rows}) if master is None else master
    return {
        "transactions": transactions(spark, rows),
        "customer_master": conform(
            spark.createDataFrame([(c, "West") for c in customers], "customer_id string, region string"),
            "customer_master",
        ),
        "web_events": conform(
            spark.createDataFrame(
                list(web),
                "event_id string, customer_id string, session_id string, event_date date,"
                "page_type string, device string, search_flag long",
            ),
            "web_events",
        ),
        "loyalty": conform(
            spark.createDataFrame(
                list(loyalty), "customer_id string, loyalty_tier string, points_balance long"
            ),
            "loyalty",
        ),
    }


def buy(customer, date, amount=10.0, category="Paint", channel="online", promo=False, discount=0.0):
    return (customer, date, amount, category, channel, promo, discount)


def by_customer(df):
    return {r.customer_id: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def result(spark):
    new = D(2024, 8, 31)
    edge = new - dt.timedelta(days=84)
    rows = (
        [buy("one_day", D(2024, 1, 6)) for _ in range(3)]
        + [buy("odd", D(2024, 2, 1)), buy("odd", D(2024, 2, 1))]
        + [buy("odd", D(2024, 2, 2)), buy("odd", D(2024, 2, 2))]
        + [buy("two", new), buy("two", new)]
        + [buy("edge", edge), buy("edge", edge - dt.timedelta(days=1)), buy("edge", edge)]
        + [buy("flags", new, promo=p, discount=d) for p, d in
           ((True, 0.2), (True, 0.1), (None, 0.5), (False, 0.0))]
        + [buy("no_master", new) for _ in range(3)]
        + [buy("project", new, category=c) for c in ("Lumber", "Flooring", "Lumber", "Paint")]
        + [buy("project", D(2023, 5, 1), category="Plumbing")]
        + [buy("median", new, amount=a) for a in (5.0, 1.0, 9.0, 7.0)]
    )
    web = [("e1", "odd", None, new, "product", "mobile", 1)] + [
        (f"e{i}", "odd", "s1" if i < 7 else "s2", new, "cart", "desktop", 0) for i in range(2, 8)
    ]
    master = sorted({r[0] for r in rows} - {"no_master"})
    loyal = [("odd", "Gold", 70), ("edge", "None", None)]
    return by_customer(features.customer_features(tables(spark, rows, master, web, loyal)))


def test_threshold_and_master_row(result):
    assert "two" not in result
    assert "one_day" in result
    assert "no_master" not in result


def test_one_day_history_has_no_trend(result):
    row = result["one_day"]
    assert row["frequency_trend"] is None
    assert row["monthly_frequency"] == 3.0
    assert row["weekend_ratio"] == 1.0  # a Saturday


def test_half_days_round_up(result):
    assert result["odd"]["frequency_trend"] == 0.0


def test_window_edge_is_inside(result):
    assert result["edge"]["txns_in_window"] == 2
    assert result["edge"]["weekly_purchase_frequency"] == 0.17


def test_null_flag_counts_in_neither_ratio(result):
    row = result["flags"]
    assert (row["promo_purchase_ratio"], row["full_price_ratio"]) == (0.5, 0.25)
    assert row["avg_discount_depth"] == 0.15
    assert result["odd"]["avg_discount_depth"] is None


def test_project_buyer_needs_two_recent_categories(result):
    row = result["project"]
    assert row["is_project_buyer"] == 1
    assert (row["project_category_txns"], row["maintenance_category_txns"]) == (4, 1)
    assert row["category_breadth"] == 4


def test_median_is_an_observed_value(result):
    assert result["median"]["median_basket_size"] == 5.0


def test_web_and_loyalty(result):
    row = result["odd"]
    assert row["total_sessions"] == 2  # the unknown session is none
    assert row["avg_pages_per_session"] == 3.5
    assert row["deep_browse_ratio"] == 0.5
    assert row["search_rate"] == 0.5
    assert row["mobile_ratio"] == 0.1429
    assert (row["loyalty_tier_numeric"], row["points_balance"]) == (3, 70)
    assert result["edge"]["points_balance"] == 0
    assert result["flags"]["total_sessions"] == 0


def test_quarters_set_the_window(spark):
    for month, days in ((2, 84), (5, 56), (9, 84), (12, 56)):
        t = transactions(spark, [buy("a", D(2024, month, 3))])
        assert features.reference_windows(t).first().window_days == days


def test_as_of_hides_later_rows(spark):
    rows = [buy("a", D(2024, 1, d)) for d in (1, 2, 3)] + [buy("a", D(2025, 6, 1))]
    t = tables(spark, rows)
    row = features.customer_features(t, as_of=D(2024, 1, 10)).first()
    assert row.total_transactions == 3
    assert row.days_since_last_purchase == 0
    assert features.customer_features(t).first().total_transactions == 4


def test_undated_rows_count_without_a_date(spark):
    rows = [buy("a", D(2024, 1, 1)), buy("a", D(2024, 1, 1)), buy("a", None)]
    row = features.customer_features(tables(spark, rows)).first()
    assert (row.total_transactions, row.txns_in_window) == (3, 2)


def test_dates_in_one_pass_equal_single_dates(spark):
    rows = [
        buy(f"c{i % 7}", D(2024, 1, 1) + dt.timedelta(days=3 * i), 10.0 + i, c)
        for i, c in enumerate(["Lumber", "Paint", "Flooring"] * 30)
    ]
    web = [
        (f"e{i}", f"c{i % 7}", f"s{i % 11}", D(2024, 1, 1) + dt.timedelta(days=4 * i), "cart", "mobile", 1)
        for i in range(60)
    ]
    t = tables(spark, rows, web=web)
    together = features.snapshot_features(t, days_back=(60, 30, 0), trim_web=True).collect()
    assert len({r.as_of for r in together}) == 3
    for date in {r.as_of for r in together}:
        single = features.snapshot_features(t, as_of=date, trim_web=True).collect()
        assert sorted(map(str, single)) == sorted(str(r) for r in together if r.as_of == date)


def test_events_after_a_date_change_nothing_in_its_history(spark):
    from basketlens.plans.segmentation import feature_history

    rows = [buy("c", D(2024, 1, 1) + dt.timedelta(days=7 * i)) for i in range(10)]
    web = [("e1", "c", "s1", D(2024, 2, 1), "search", "mobile", 1)]
    late = web + [("e2", "c", "s2", D(2024, 2, 29), "cart", "mobile", 0)]
    before, after = (feature_history(tables(spark, rows, web=w)).orderBy("week").collect() for w in (web, late))
    assert [r.total_sessions for r in before] == [1, 1, 1, 1]
    assert [r.total_sessions for r in after] == [1, 1, 1, 2]
    assert before[:3] == after[:3]


def test_wanted_columns_leave_the_rows_alone(spark):
    rows = [buy(c, D(2024, 1, d)) for c in "abc" for d in (1, 5, 9)]
    t = tables(spark, rows)
    whole = features.customer_features(t)
    for columns in ((), ("region",), ("search_rate", "points_balance"), ("median_basket_size", "online_ratio")):
        found = features.customer_features(t, columns=columns)
        assert set(found.columns) == {"customer_id", *columns}
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.select(found.columns).collect()))
    with pytest.raises(ValueError, match="unknown features"):
        features.customer_features(t, columns=["height"])


def test_schema_and_one_row_per_customer(spark):
    rows = [buy(c, D(2024, 1, d)) for c in "abc" for d in (1, 5, 9)]
    df = features.customer_features(tables(spark, rows))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in SCHEMAS["customer_features"]
    ]
    assert df.count() == df.select("customer_id").distinct().count() == 3
