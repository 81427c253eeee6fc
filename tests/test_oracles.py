"""Queries against their SQL on the smallest tables.

By default a cross-section runs; CHECK_ALL=1 runs every query that has SQL.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from basketlens.checks.oracles import all_oracles
from basketlens.checks.queries import all_queries
from tests.compare import differences, duck

DATA = "/root/testdata/sf0.001"
CROSS_SECTION = (
    "s2_coerce_dates s3_required_violations s10_assignments e2_transactions_profile "
    "e3_category_distribution e4_customer_txn_summary e6_old_segment_behavior "
    "e7_old_segment_campaigns r13_customer_features p5_summary_before p7_processed_features "
    "c5_silhouette_squared c7_label_agreement c14_profile_long v2_exact_halves v5_pvalues "
    "v6_pvalue v7_conversion_ci v9_per_segment v12_migration_matrix d1_distribution_alerts "
    "d2_new_customers d5_feature_drift x1_segment_health x2_health_by_quarter "
    "x4_campaign_performance x9_churn_summary"
).split()
NAMES = sorted(entry.oracle_sql()) if os.environ.get("CHECK_ALL") else CROSS_SECTION


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, connection, name):
    found = differences(entry.queries()[name](spark, DATA), connection, entry.oracle_sql()[name])
    assert not found, "\n".join(found)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_only_model_fits_lack_sql():
    without = set(all_queries()) - set(all_oracles())
    assert without == {
        "c2_kmeans",
        "c3_k_selection",
        "c4_hierarchical",
        "c6_gmm",
        "c8_method_comparison",
        "c15_summary",
    }
