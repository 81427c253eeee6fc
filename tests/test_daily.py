"""Daily sums kept up to date against features rebuilt from all rows."""

from __future__ import annotations

import datetime as dt
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from basketlens.operators.features import customer_features
from basketlens.plans.daily import DailyStore
from basketlens.plans.refresh import refresh_features
from basketlens.plans.segmentation import feature_history
from basketlens.sources.sample_views import sample_tables
from basketlens.sources.sinks import replace_table
from basketlens.sources.tables import TableRegistry, create_database

DATA = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(str(sorted(r.asDict().items())) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    """All rows moved into the last 90 days, and some transactions without a date."""
    found = dict(sample_tables(spark, DATA))
    for name, date in (("transactions", "transaction_date"), ("web_events", "event_date")):
        newest = found[name].agg(F.max(date)).first()[0]
        age = F.datediff(F.lit(newest), F.col(date)) % 90
        found[name] = found[name].withColumn(date, F.date_sub(F.lit(newest), age))
    unknown = found["transactions"].limit(5).withColumn("transaction_date", F.lit(None).cast("date"))
    return found | {"transactions": found["transactions"].unionByName(unknown)}


@pytest.fixture(scope="module")
def store(spark, tables):
    """All but the last weeks first, then the rest, some days of it twice."""
    kept = DailyStore(spark, tempfile.mkdtemp(prefix="basketlens-daily-"))
    for table, date in (("transactions", "transaction_date"), ("web_events", "event_date")):
        newest = tables[table].agg(F.max(date)).first()[0]
        late = F.coalesce(F.col(date) > newest - dt.timedelta(days=14), F.lit(False))
        kept.load(tables[table].where(~late), table)
        wrong = tables[table].where(late).limit(20)
        kept.load(wrong, table)
        loaded = kept.load(tables[table].where(late), table)
        assert 0 < len(loaded) <= 14
    return kept


def test_features_equal_a_full_rebuild(tables, store):
    kept = {**store.tables(), "customer_master": tables["customer_master"], "loyalty": tables["loyalty"]}
    assert rows_of(customer_features(kept)) == rows_of(customer_features(tables))
    as_of = tables["transactions"].agg(F.max("transaction_date")).first()[0] - dt.timedelta(days=10)
    assert rows_of(customer_features(kept, as_of, trim_web=True)) == rows_of(customer_features(tables, as_of, trim_web=True))
    assert customer_features(tables, as_of).count() > 20
    assert rows_of(feature_history(kept, weeks=2)) == rows_of(feature_history(tables, weeks=2))


def test_sums_of_new_days_read_only_these(store):
    """The scan below the sums has the days as partition filters."""
    newest = store.base_rows("transactions").agg(F.max("transaction_date")).first()[0]
    days = [newest, newest - dt.timedelta(days=3)]
    text = store.base_rows("transactions", days)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[day#\d+ IN \(", text)
    listed = store.base_rows("transactions", days).select(F.input_file_name()).distinct().collect()
    assert {re.search("day=([-0-9]+)", r[0]).group(1) for r in listed} <= {str(d) for d in days}
    unknown = store.base_rows("transactions", [None])
    assert unknown.count() == 5


def test_features_do_not_read_base_rows(tables, store):
    kept = {**store.tables(), "customer_master": tables["customer_master"], "loyalty": tables["loyalty"]}
    text = customer_features(kept)._jdf.queryExecution().executedPlan().toString()
    assert "daily_purchases" in text and "/transactions" not in text and "/web_events" not in text


def test_refresh_from_the_store(spark, tables, store):
    registry = TableRegistry(spark, "daily_db")
    create_database(spark, "daily_db")
    for name in ("customer_master", "loyalty"):
        replace_table(tables[name], "daily_db", name)
    rows = refresh_features(registry, store=store)
    assert rows == customer_features(tables).count()
    assert rows_of(registry.read("customer_features")) == rows_of(customer_features(tables))
