"""What the plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from basketlens.constants import CHURN_COLUMNS, CLUSTER_FEATURES, DRIFT_FEATURES
from basketlens.functions.ranks import midpoint_median
from basketlens.operators import experiment, features, profiling, reports
from basketlens.operators.clustering import assign_nearest
from basketlens.operators.prepare import clustering_input
from basketlens.plans.segmentation import feature_history
from basketlens.sources.sample_views import sample_tables
from basketlens.sources.tables import TableRegistry

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().treeString()


@pytest.fixture(scope="module")
def stored(spark):
    """The base tables as plain Parquet, as a cluster would hold them."""
    root = tempfile.mkdtemp(prefix="basketlens-plans-")
    registry = TableRegistry(spark, path=root)
    for name, df in sample_tables(spark, DATA).items():
        df.write.parquet(registry.name(name))
    names = ("transactions", "web_events", "loyalty", "customer_master", "old_segments", "campaigns")
    found = {name: registry.read(name) for name in (*names, "segment_assignments")}
    return found


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_features_plan(stored, no_broadcast):
    text = plan(features.customer_features(stored))
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text
    assert "BroadcastExchange" not in text


def test_raw_transactions_are_summed_before_the_customer_shuffle(stored, no_broadcast):
    windows = features.reference_windows(stored["transactions"])
    text = plan(features.purchase_features(stored["transactions"], windows))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    keys = [re.sub(r"#\d+L?", "", s) for s in shuffles]
    assert keys == ["customer_id, 8", "customer_id, category, transaction_date, 8"]
    # Rows are counted below the shuffle by customer, which carries sums.
    assert text.index("REPARTITION_BY_COL") < text.index("partial_count(1)")


def test_scan_reads_only_what_is_needed(stored):
    text = plan(features.eligible_customers(stored["transactions"]))
    assert "ReadSchema: struct<customer_id:string>" in text
    median = plan(features.median_baskets(stored["transactions"]))
    assert "struct<customer_id:string,amount:double>" in median
    as_of = features.reference_windows(stored["transactions"], as_of=dt.date(2001, 1, 1))
    assert "LessThanOrEqual(transaction_date" in plan(as_of)


def test_reports_join_sums_and_not_transactions(stored, no_broadcast):
    for report in (reports.segment_health, reports.segment_health_by_quarter):
        text = plan(report(stored["segment_assignments"], stored["transactions"]))
        assert text.index("SortMergeJoin") < text.index("partial_sum(amount#")


def below_exchanges(text):
    """Of each shuffle of a plan the first line below it that is no sort or projection."""
    lines = [re.sub(r"^[ :+\-*()\d]*", "", line) for line in text.splitlines()]
    for at, line in enumerate(lines):
        if line.startswith("Exchange"):
            yield next(x for x in lines[at + 1 :] if not x.startswith(("Sort ", "Project")))


def test_medians_shuffle_counts_and_no_rows(spark, stored, no_broadcast):
    """Every shuffle stands on a partial aggregate; there is no window, join or broadcast."""
    transactions = stored["transactions"]
    raw = spark.createDataFrame(features.customer_features(stored).collect())
    for df in (
        profiling.transactions_profile(transactions),
        features.median_baskets(transactions),
        experiment.split_holdout(transactions.select("customer_id"), exact=True),
        midpoint_median(raw.select("region", "avg_basket_size"), ["region"], "avg_basket_size", "m"),
    ):
        text = plan(df)
        assert not re.search("Window|Join|BroadcastExchange", text)
        below = list(below_exchanges(text))
        assert below and all("Aggregate" in line and re.search(r"partial_|merge_|functions=\[\]", line) for line in below)


def test_the_median_of_segments_reads_counts(stored, no_broadcast):
    text = plan(profiling.old_segment_behavior(stored["old_segments"], stored["transactions"]))
    assert "BroadcastExchange" not in text and "Window" not in text


def test_scoring_has_no_join(stored, spark):
    raw = spark.createDataFrame(features.customer_features(stored).collect()[:5])
    scaled = clustering_input(raw)
    text = plan(assign_nearest(scaled, {0: [0.0] * 11, 1: [1.0] * 11}))
    assert "Join" not in text and "Python" not in text


def test_a_hot_customer_does_not_reach_one_task(spark, stored):
    """A third of all rows belongs to one customer; no shuffled group stays that large."""
    rows = stored["transactions"].count()
    hot = stored["transactions"].withColumn(
        "customer_id",
        F.when(F.xxhash64("transaction_id") % 3 == 0, "CUST_1").otherwise(F.col("customer_id")),
    )
    daily = features.daily_purchases(hot)
    largest = daily.groupBy("customer_id").count().agg(F.max("count")).first()[0]
    days = hot.select("transaction_date").distinct().count()
    assert rows / 3 * 0.8 < hot.where("customer_id = 'CUST_1'").count()
    assert largest <= days * 10
    tables = {**stored, "transactions": hot}
    row = features.customer_features(tables).where("customer_id = 'CUST_1'").first()
    amounts = sorted(r.amount for r in hot.where("customer_id = 'CUST_1'").collect())
    assert row.total_transactions == len(amounts)
    assert row.median_basket_size == pytest.approx(amounts[(len(amounts) - 1) // 2])


def test_branches_nobody_wants_are_not_built(stored):
    for columns in (CLUSTER_FEATURES, DRIFT_FEATURES, CHURN_COLUMNS, ()):
        text = plan(features.customer_features(stored, columns=columns))
        assert "percentile_disc" not in text
    assert "web_events" not in plan(features.customer_features(stored, columns=CHURN_COLUMNS))
    history = feature_history(stored, columns=CLUSTER_FEATURES)
    assert "percentile_disc" not in plan(history) and "loyalty_tier" not in plan(history)


def test_a_history_repeats_sums_and_no_rows(stored, no_broadcast):
    """Below each repetition per date stands an aggregate, in every branch of the plan."""
    lines = plan(feature_history(stored)).splitlines()
    depth = [len(re.match(r"^[ :+\-*()\d]*", line).group()) for line in lines]
    generates = [at for at, line in enumerate(lines) if re.match(r"^[ :+\-*()\d]*Generate (?:explode|inline)", line)]
    assert len(generates) >= 3
    for at in generates:
        below = []
        for further in range(at + 1, len(lines)):
            if depth[further] <= depth[at]:
                break
            below.append(lines[further])
        scan = next(i for i, line in enumerate(below) if "FileScan" in line)
        assert any("Aggregate(" in line for line in below[:scan])


def test_a_hot_customer_in_segments_and_campaigns(spark, stored):
    """E6 and V3 with a customer who owns a third of the rows equal sums made by hand."""
    def heated(df, key):
        hot = F.xxhash64(key) % 3 == 0
        return df.withColumn("customer_id", F.when(hot, "CUST_1").otherwise(F.col("customer_id")))

    transactions = heated(stored["transactions"], "transaction_id")
    rows = transactions.join(stored["old_segments"], "customer_id").select("segment_name", "amount").collect()
    amounts = {}
    for r in rows:
        amounts.setdefault(r.segment_name, []).append(r.amount)
    found = profiling.old_segment_behavior(stored["old_segments"], transactions).collect()
    medians = {r.segment_name: r.median_basket for r in found}
    for name, values in amounts.items():
        values.sort()
        assert medians[name] == pytest.approx(values[(len(values) - 1) // 2], abs=0.006)
    campaigns = heated(stored["campaigns"], "revenue")
    results = experiment.holdout_results(campaigns, stored["segment_assignments"], stored["old_segments"])
    assert results.count() == campaigns.count()
    assert results.where("customer_id = 'CUST_1'").select("test_group", "segment_used").distinct().count() == 1
