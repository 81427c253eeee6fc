"""The weekly refresh: features, processed table, assignments, log, reports, checks.

Each step reads the table the step before has written, so a lost executor costs one
step's tasks and no step drags the plans of all earlier ones along.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.constants import CLUSTER_FEATURES, PROCESSED_FEATURES, PROCESSED_LOG_FEATURES
from basketlens.operators import drift, experiment, reports
from basketlens.operators.clustering import (
    RESTARTS,
    as_vectors,
    compare_methods,
    k_selection,
    silhouette,
)
from basketlens.operators.features import customer_features, reference_windows
from basketlens.operators.migration import migration
from basketlens.operators.prepare import (
    clustering_input,
    processed_features,
    scaling,
    unscaled_input,
)
from basketlens.operators.segments import (
    name_segments,
    profile_segments,
    run_summary,
    segment_assignments,
)
from basketlens.plans.daily import DailyStore
from basketlens.plans.segmentation import fit_segmentation, score
from basketlens.sources.schemas import SCHEMAS
from basketlens.sources.sinks import (
    cut_lineage,
    export_csv,
    keep_previous,
    load_model,
    replace_table,
    save_model,
)
from basketlens.sources.tables import (
    TableRegistry,
    create_database,
    read_checked,
    read_files,
    split_rejects,
    table_exists,
)

FEATURE_TABLES = ("customer_master", "transactions", "web_events", "loyalty")
#: The scale of the processed table, one column of mean and deviation per feature.
SCALE_TABLE = "customer_features_scale"
#: Quantile sketches of the features of every refresh.
SKETCH_TABLE = "customer_features_sketches"
#: Sales per customer and quarter.
SALES_TABLE = "customer_sales"
#: Rows that the last load could not use.
REJECT_TABLE = "load_rejects"


def load_tables(
    registry: TableRegistry, paths: dict[str, str], fmt: str = "parquet"
) -> DataFrame:
    """Load the base tables from files: typed, checked for required columns, counted."""
    create_database(registry.spark, registry.database)
    counts = []
    for table, path in paths.items():
        rows = read_files(registry.spark, table, path, fmt)
        counts.append((table, replace_table(rows, registry.database, table)))
    return registry.spark.createDataFrame(counts, "table_name string, row_count long")


def load_checked(registry: TableRegistry, paths: dict[str, str], fmt: str = "csv") -> DataFrame:
    """Load base tables from text files: good rows become the tables, bad ones are kept.

    The bad rows of a load are in the table ``load_rejects`` with their text, file and
    reason; the result counts the rows per table and reason, null being the good ones.
    """
    spark, database = registry.spark, registry.database
    create_database(spark, database)
    counts, rejects = [], []
    for table, path in paths.items():
        # The files are read once; both tables are written from the checked copy.
        checked = cut_lineage(read_checked(spark, table, path, fmt))
        good, bad = split_rejects(checked, table)
        counts.append((table, None, replace_table(good, database, table)))
        rejects.append(bad)
    replace_table(reduce(DataFrame.unionByName, rejects), database, REJECT_TABLE)
    per_reason = spark.table(f"{database}.{REJECT_TABLE}").groupBy("table_name", "reason")
    loaded = spark.createDataFrame(counts, "table_name string, reason string, row_count long")
    return loaded.unionByName(per_reason.agg(F.count("*").alias("row_count")))


def refresh_date(registry: TableRegistry, as_of: dt.date | None = None) -> dt.date:
    """The date of a refresh: the one given, or that of the newest transaction."""
    return as_of or reference_windows(registry.read("transactions")).first()["as_of"]


def refresh_features(
    registry: TableRegistry,
    as_of: dt.date | None = None,
    refit_scale: bool = True,
    store: DailyStore | None = None,
) -> int:
    """Rebuild the feature table and the processed table from the base tables.

    With ``store`` the features come from its daily sums; new days are loaded there first,
    and the rows of earlier days are not read again.

    The features of the last refresh are kept for the drift checks. The scale of the
    processed table is stored beside it; ``refit_scale=False`` uses the stored one.
    """
    spark, database = registry.spark, registry.database
    create_database(spark, database)
    if store is None:
        date = refresh_date(registry, as_of)
        tables = {name: registry.read(name) for name in FEATURE_TABLES}
    else:
        tables = store.tables() | {name: registry.read(name) for name in ("customer_master", "loyalty")}
        date = as_of or reference_windows(tables["daily_purchases"]).first()["as_of"]
    keep_previous(spark, database, "customer_features", date)
    rows = replace_table(
        customer_features(tables, as_of), database, "customer_features", "customer_id", date, registry.buckets
    )
    _store_sketches(registry, date)
    features = registry.read("customer_features")
    if refit_scale or not table_exists(spark, f"{database}.{SCALE_TABLE}"):
        unscaled = unscaled_input(features, PROCESSED_FEATURES, PROCESSED_LOG_FEATURES)
        replace_table(scaling(unscaled, PROCESSED_FEATURES), database, SCALE_TABLE)
    scale = spark.table(f"{database}.{SCALE_TABLE}")
    processed = processed_features(features, stats=scale)
    replace_table(processed, database, "customer_features_processed", "customer_id", date, registry.buckets)
    return rows


def refresh_sales(registry: TableRegistry) -> int:
    """Sales per customer and quarter for the reports, bucketed as the other tables are."""
    sales = reports.customer_sales(registry.read("transactions"))
    return replace_table(sales, registry.database, SALES_TABLE, "customer_id", None, registry.buckets)


def _store_sketches(registry: TableRegistry, date: dt.date) -> None:
    """Add the distributions of this refresh, or replace those of a refresh of its date."""
    spark, name = registry.spark, f"{registry.database}.{SKETCH_TABLE}"
    new = drift.feature_sketches(registry.read("customer_features")).withColumn("refresh_date", F.lit(date))
    if table_exists(spark, name):
        new = spark.table(name).where(F.col("refresh_date") != F.lit(date)).unionByName(new)
    replace_table(new, registry.database, SKETCH_TABLE)


def review_model(
    registry: TableRegistry, ks: Sequence[int] = range(2, 11), **options: object
) -> dict[str, DataFrame]:
    """What to look at before a model is stored: numbers of clusters, methods, summary."""
    features = registry.read("customer_features")
    vectors = cut_lineage(as_vectors(clustering_input(features)).select("customer_id", "features"))
    model = fit_segmentation(features, **options)
    scored = model.transform(features)
    names = name_segments(profile_segments(scored))
    assigned = segment_assignments(scored, names, F.lit(refresh_date(registry)))
    return {
        "k_selection": k_selection(vectors, ks, restarts=options.get("restarts", RESTARTS)),
        "method_comparison": compare_methods(vectors),
        "summary": run_summary(assigned, len(CLUSTER_FEATURES), silhouette(scored, "segment_id")),
    }


def refresh_model(registry: TableRegistry, model_path: str, **options: object) -> PipelineModel:
    """Fit on the current features and store the model; done now and then, not weekly."""
    model = fit_segmentation(registry.read("customer_features"), **options)
    save_model(model, model_path)
    return model


def refresh_assignments(
    registry: TableRegistry, model_path: str, as_of: dt.date | None = None
) -> int:
    """Score the features with the stored model and replace the assignment table.

    The assignments of the last refresh are kept, and the migration from them goes to the
    log under this refresh's date. Repeating a refresh, also one that broke off, replaces
    its assignments and its log entry and adds no second one.
    """
    spark, database = registry.spark, registry.database
    features = registry.read("customer_features")
    scored = score(load_model(model_path), features)
    names = name_segments(profile_segments(scored))
    date = refresh_date(registry, as_of)
    assigned = segment_assignments(scored, names, F.lit(date))
    keep_previous(spark, database, "segment_assignments", date)
    rows = replace_table(assigned, database, "segment_assignments", "customer_id", date, registry.buckets)
    before = _previous(registry, "segment_assignments")
    if before is not None:
        _log_migration(registry, migration(before, registry.read("segment_assignments")), date)
    return rows


def _previous(registry: TableRegistry, table: str) -> DataFrame | None:
    """The table as the refresh before left it."""
    name = f"{registry.database}.{table}_previous"
    return registry.spark.table(name) if table_exists(registry.spark, name) else None


def _log_migration(registry: TableRegistry, moved: DataFrame, date: dt.date) -> None:
    columns = SCHEMAS["segment_migration_log"].names
    entry = moved.select(
        "customers_shifted", "migration_rate", "stability_pass", F.lit(date).alias("refresh_date")
    )
    if table_exists(registry.spark, registry.name("segment_migration_log")):
        log = registry.read("segment_migration_log").select(*columns)
        others = log.where(F.col("refresh_date") != F.lit(date))
        week = F.coalesce(others.agg(F.max("week")).scalar(), F.lit(0)) + 1
        log = others.unionByName(entry.withColumn("week", week))
    else:
        log = entry.withColumn("week", F.lit(1))
    replace_table(log, registry.database, "segment_migration_log")


def refresh_holdout(registry: TableRegistry) -> int:
    """Bring campaign outcomes, groups and segments together in the results table."""
    results = experiment.holdout_results(
        registry.read("campaigns"),
        registry.read("segment_assignments"),
        registry.read("old_segments"),
    )
    return replace_table(results, registry.database, "campaign_holdout_results")


def holdout_tests(registry: TableRegistry) -> dict[str, DataFrame]:
    """The tests of the stored results: rates, significance, revenue, interval, segments."""
    results = registry.read("campaign_holdout_results")
    return {
        "group_sizes": experiment.group_sizes(results),
        "rates_and_lift": experiment.rates_and_lift(results),
        "proportion_tests": experiment.proportion_tests(results),
        "revenue_test": experiment.revenue_test(results),
        "conversion_interval": experiment.conversion_interval(results),
        "treatment_by_segment": experiment.treatment_by_segment(results),
    }


def report_tables(registry: TableRegistry) -> dict[str, DataFrame]:
    """The nine reports over the current tables."""
    assignments = registry.read("segment_assignments")
    transactions = registry.read("transactions")
    features = registry.read("customer_features")
    holdout = registry.read("campaign_holdout_results")
    sales = f"{registry.database}.{SALES_TABLE}"
    sales = registry.spark.table(sales) if table_exists(registry.spark, sales) else None
    return {
        "01_segment_health": reports.segment_health(assignments, transactions, sales),
        "02_segment_health_over_time": reports.segment_health_by_quarter(
            assignments, transactions, sales
        ),
        "03_segment_migration": reports.migration_report(registry.read("segment_migration_log")),
        "04_campaign_performance": reports.campaign_performance(holdout),
        "05_campaign_summary": reports.campaign_summary(holdout),
        "06_segment_profiles": reports.customer_profiles(assignments, features),
        "07_segment_profile_summary": reports.profile_summary(assignments, features),
        "08_churn_indicators": reports.churn_indicators(assignments, features),
        "09_churn_summary": reports.churn_summary(assignments, features),
    }


def export_reports(registry: TableRegistry, directory: str, hold_on_alert: bool = False) -> list[str]:
    """Write the nine reports; returns the checks that raise an alert.

    ``hold_on_alert`` writes none while there is an alert, until someone has looked at it and
    exports without this.
    """
    alerts = raised_alerts(registry)
    if not (alerts and hold_on_alert):
        export_csv(report_tables(registry), directory)
    return alerts


def drift_tables(registry: TableRegistry) -> dict[str, DataFrame]:
    """The checks to read before marketing acts on new segments.

    Shares and features are compared with those of the refresh before, once there is one.
    """
    assignments = registry.read("segment_assignments")
    features = registry.read("customer_features")
    previous = _previous(registry, "segment_assignments")
    checks = {
        "segment_distribution": drift.segment_distribution(assignments, previous),
        "new_customers": drift.new_customers(registry.read("transactions"), assignments),
        "feature_stats": drift.feature_stats(features),
    }
    if table_exists(registry.spark, registry.name("segment_migration_log")):
        log = registry.read("segment_migration_log")
        checks["latest_migration"] = drift.latest_migration(log)
    before = _previous(registry, "customer_features")
    if before is not None:
        checks["feature_drift"] = drift.feature_drift(before, features)
    sketches = registry.spark.table(f"{registry.database}.{SKETCH_TABLE}")
    dates = [row[0] for row in sketches.select("refresh_date").distinct().orderBy(F.desc("refresh_date")).take(2)]
    if len(dates) == 2:
        older, newer = (sketches.where(F.col("refresh_date") == F.lit(date)) for date in reversed(dates))
        checks["distribution_drift"] = drift.distribution_drift(older, newer)
    return checks


def raised_alerts(registry: TableRegistry) -> list[str]:
    """The checks with an alert; each check is one row per segment or feature at most."""
    checks = drift_tables(registry).items()
    raised = F.coalesce(F.col("alert").cast("string"), F.lit("false")) != "false"
    return [name for name, df in checks if "alert" in df.columns and not df.where(raised).isEmpty()]
