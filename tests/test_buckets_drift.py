"""Bucketed tables meet without a shuffle; sketches tell how distributions moved."""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.operators import drift, reports
from basketlens.plans import refresh
from basketlens.sources.sample_views import sample_tables
from basketlens.sources.sinks import replace_table
from basketlens.sources.tables import TableRegistry, conform, create_database

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def registry(spark, tmp_path_factory):
    found = TableRegistry(spark, "bucketed", buckets=4)
    paths = {}
    for name, df in sample_tables(spark, DATA).items():
        if name != "segment_assignments":
            paths[name] = str(tmp_path_factory.mktemp("load") / name)
            conform(df, name).write.parquet(paths[name])
    refresh.load_tables(found, paths)
    model = str(tmp_path_factory.mktemp("model") / "m")
    refresh.refresh_features(found, dt.date(2001, 6, 1))
    refresh.refresh_model(found, model, restarts=2)
    for date in (dt.date(2001, 6, 1), None, None):
        refresh.refresh_features(found, date)
        refresh.refresh_assignments(found, model, date)
    refresh.refresh_sales(found)
    refresh.refresh_holdout(found)
    return found


def test_report_joins_have_no_shuffle_below(spark, registry):
    """What is below the join of a report reads buckets; sorting and summing need no exchange."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = refresh.report_tables(registry)
        for name in ("01_segment_health", "02_segment_health_over_time", "06_segment_profiles",
                     "07_segment_profile_summary", "08_churn_indicators", "09_churn_summary"):
            text = tables[name]._jdf.queryExecution().executedPlan().toString()
            below = text[text.index("SortMergeJoin") : text.index("===") if "===" in text else None]
            below = below.split("\n(")[0]
            assert "Exchange" not in below and below.count("Bucketed: true") >= 2, (name, below)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_from_sales_equal_those_from_transactions(spark, registry):
    assignments, transactions = registry.read("segment_assignments"), registry.read("transactions")
    sales = spark.table(f"bucketed.{refresh.SALES_TABLE}")
    for report in (reports.segment_health, reports.segment_health_by_quarter):
        assert report(assignments, sales=sales).collect() == report(assignments, transactions).collect()


def test_buckets_may_change(spark):
    create_database(spark, "rebucketed")
    rows = spark.range(50).select(F.col("id").cast("string").alias("customer_id"))
    for buckets in (None, 4, 4, 3, None):
        replace_table(rows, "rebucketed", "plain", "customer_id", None, buckets)
        described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED rebucketed.plain").collect()}
        assert described.get("Num Buckets") == (str(buckets) if buckets else None)
        assert spark.table("rebucketed.plain").count() == 50


def test_refresh_keeps_sketches_by_date_and_reports_wait(spark, registry, tmp_path):
    sketches = spark.table(f"bucketed.{refresh.SKETCH_TABLE}")
    assert sketches.select("refresh_date").distinct().count() == 2
    checks = refresh.drift_tables(registry)
    moved = {r.feature: r for r in checks["distribution_drift"].collect()}
    assert moved["days_since_last_purchase"].alert
    held = refresh.export_reports(registry, str(tmp_path / "held"), hold_on_alert=True)
    assert "distribution_drift" in held and not (tmp_path / "held").exists()
    assert refresh.export_reports(registry, str(tmp_path / "out")) == held
    assert len(list((tmp_path / "out").iterdir())) == 9


def largest_gap(a, b):
    values = np.unique(np.concatenate([a, b]))
    return max(abs(np.searchsorted(np.sort(a), v, "right") / len(a) - np.searchsorted(np.sort(b), v, "right") / len(b)) for v in values)


def test_shifts_are_within_the_stated_error(spark):
    """Continuous, tied and shifted columns, one with an equal mean but another spread."""
    rng = np.random.default_rng(4)
    n = 20_000
    before = {"same": rng.normal(0, 1, n), "spread": rng.normal(0, 1, n), "ties": rng.integers(0, 4, n) * 1.0, "moved": rng.exponential(1, n)}
    after = {"same": rng.normal(0, 1, n), "spread": rng.normal(0, 2, n), "ties": rng.integers(0, 3, n) * 1.0, "moved": rng.exponential(1, n) + 0.2}
    names = list(before)
    frames = [spark.createDataFrame([tuple(map(float, r)) for r in zip(*d.values())], names).repartition(6) for d in (before, after)]
    sketches = [drift.feature_sketches(df, names) for df in frames]
    found = {r.feature: r for r in drift.distribution_drift(*sketches).collect()}
    for name in names:
        exact = largest_gap(before[name], after[name])
        assert found[name].largest_shift == pytest.approx(exact, abs=0.01 + 2 * drift.SKETCH_ERROR)
        assert found[name].alert == (exact > 0.1)
    sizes = sketches[0].select(F.max(F.octet_length("sketch"))).first()[0]
    assert sizes < 64 * drift.SKETCH_SIZE


def test_a_feature_without_values_is_left_out(spark):
    empty = spark.createDataFrame([(None, 1.0)], "a double, b double")
    sketches = drift.feature_sketches(empty, ["a", "b"])
    assert [r.feature for r in drift.distribution_drift(sketches, sketches).collect()] == ["b"]
