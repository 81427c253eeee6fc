"""Readers, checks, sinks and the whole refresh on a local warehouse."""

from __future__ import annotations

import datetime as dt
import json
import threading
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from basketlens.plans import refresh
from basketlens.plans.segmentation import fit_segmentation, score
from basketlens.sources import sinks
from basketlens.sources.sample_views import sample_tables
from basketlens.sources.schemas import SCHEMAS, feature_columns, required_columns
from basketlens.sources.sinks import export_csv, load_model, replace_table, save_model, write_week
from basketlens.sources.tables import (
    RequiredColumnError,
    TableRegistry,
    conform,
    create_database,
    read_files,
    required_violations,
    text_to_dates,
)

DATA = "/root/testdata/sf0.001"


def test_schemas():
    assert len(SCHEMAS) == 11
    assert len(feature_columns()) == 28
    assert required_columns("transactions") == ["transaction_id", "customer_id"]


def test_unreadable_dates_become_null(spark):
    df = spark.createDataFrame([("2024-02-30",), ("n/a",), ("2024-02-03",), (None,)], "d string")
    found = [r.d for r in text_to_dates(df, ["d", "absent"]).collect()]
    assert found == [None, None, dt.date(2024, 2, 3), None]


def test_csv_and_json_scans(spark, tmp_path):
    text = "customer_id,loyalty_tier,points_balance,enrollment_date,last_activity_date\n"
    (tmp_path / "l.csv").write_text(text + "a,Gold,5,2024-01-02,n/a\nb,,,,2024-05-06\n")
    found = read_files(spark, "loyalty", str(tmp_path / "l.csv"), "csv").collect()
    assert found[0].enrollment_date == dt.date(2024, 1, 2)
    assert found[0].last_activity_date is None
    assert found[1].points_balance is None
    (tmp_path / "l.json").write_text('{"customer_id": "a", "points_balance": 7}\n')
    assert read_files(spark, "loyalty", str(tmp_path / "l.json"), "json").first().points_balance == 7


def test_required_columns_are_counted_and_refused(spark):
    df = conform(spark.createDataFrame([("a",), (None,)], "customer_id string"), "loyalty")
    assert required_violations({"loyalty": df}).first().null_count == 1
    create_database(spark, "checks")
    with pytest.raises(PySparkException, match="required but null"):
        replace_table(df, "checks", "loyalty")
    with pytest.raises(RequiredColumnError):
        conform(df.drop("customer_id"), "loyalty")


def test_replace_may_read_what_it_replaces(spark):
    create_database(spark, "replacing")
    first = spark.range(5).select(F.col("id").cast("string").alias("customer_id"))
    assert replace_table(conform(first, "loyalty"), "replacing", "loyalty", "customer_id") == 5
    doubled = spark.table("replacing.loyalty").union(spark.table("replacing.loyalty"))
    assert replace_table(doubled, "replacing", "loyalty") == 10
    assert spark.table("replacing.loyalty").count() == 10
    assert {t.name for t in spark.catalog.listTables("replacing") if not t.isTemporary} == {"loyalty"}


CSV = """transaction_id,customer_id,transaction_date,channel,category,amount,discount_pct,promo_flag
t1,c1,2024-01-05,store,paint,12.50,0.1,true
t2,c1,not a date,store,paint,3.00,0.0,false
t3,c2,2024-02-30,store,paint,3.00,0.0,false
t4,c2,2024-01-06,store,paint,many,0.0,false
t5,,2024-01-06,store,paint,4.00,0.0,false
t6,c3,,online,tools,5.25,,
t7,c3,2024-01-07,online,tools,5.25,0.0,maybe
t8,c3
"""


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_bad_rows_are_kept_and_counted(spark, tmp_path, fmt):
    """Each bad row is kept with its text and a reason, and no good row is lost beside it."""
    columns = [f.name for f in SCHEMAS["transactions"].fields]
    lines = [dict(zip(CSV.splitlines()[0].split(","), row.split(","))) for row in CSV.splitlines()[1:]]
    if fmt == "csv":
        text = "\n".join([",".join(columns), *[",".join(r.get(c) or "" for c in columns) if len(r) > 2 else "t8,c3" for r in lines]])
    else:
        kinds = {"amount": lambda x: float(x) if x != "many" else x, "discount_pct": float, "promo_flag": lambda x: {"true": True, "false": False}.get(x, x)}
        text = "\n".join(json.dumps({k: kinds.get(k, str)(v) for k, v in r.items() if v}) if len(r) > 2 else "{" for r in lines)
    (tmp_path / "rows").write_text(text + "\n")
    registry = TableRegistry(spark, f"rejecting_{fmt}")
    counts = {(r.table_name, r.reason): r.row_count for r in refresh.load_checked(registry, {"transactions": str(tmp_path / "rows")}, fmt).collect()}
    assert counts == {
        ("transactions", None): 2, ("transactions", "unreadable row"): 3,
        ("transactions", "unreadable date"): 2, ("transactions", "required column empty"): 1,
    }
    assert [r.transaction_id for r in registry.read("transactions").orderBy("transaction_id").collect()] == ["t1", "t6"]
    rejects = spark.table(f"rejecting_{fmt}.{refresh.REJECT_TABLE}").collect()
    assert {r.detail for r in rejects} == {None, "transaction_date", "customer_id"}
    assert all(r.file.endswith("rows") and r.record for r in rejects)
    assert any("many" in r.record for r in rejects)


def numbers(spark, n):
    return conform(spark.range(n).select(F.col("id").cast("string").alias("customer_id")), "loyalty")


def test_readers_meet_a_table_between_all_steps(spark, monkeypatch):
    """Before and after each statement of a replacement the table has its old or its new rows."""
    create_database(spark, "steps")
    replace_table(numbers(spark, 5), "steps", "loyalty")
    begun = spark.table("steps.loyalty")
    plain, seen = type(spark).sql, []

    def look():
        seen.append(plain(spark, "SELECT count(*) AS n FROM steps.loyalty").first()["n"])

    def watched(self, text, *args, **kwargs):
        look()
        out = plain(self, text, *args, **kwargs)
        look()
        return out

    monkeypatch.setattr(type(spark), "sql", watched)
    clean, write = sinks._delete_others, sinks.conform
    monkeypatch.setattr(sinks, "conform", lambda *a: look() or write(*a))
    monkeypatch.setattr(sinks, "_delete_others", lambda *a, **b: look() or clean(*a, **b) or look())
    replace_table(numbers(spark, 8), "steps", "loyalty", refresh_date=dt.date(2024, 5, 6))
    assert set(seen) == {5, 8} and seen == sorted(seen) and len(seen) > 5
    assert sinks.stored_date(spark, "steps", "loyalty") == dt.date(2024, 5, 6)
    # A query built before still finds its rows; the version before is kept for it.
    assert begun.count() == 5


def test_readers_in_another_thread(spark):
    create_database(spark, "threads")
    replace_table(numbers(spark, 1), "threads", "loyalty")
    done, found, failed = threading.Event(), [], []

    def read():
        while not done.is_set():
            try:
                found.append(spark.table("threads.loyalty").count())
            except Exception as error:  # the reader must not meet one
                failed.append(str(error)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 8):
        replace_table(numbers(spark, n), "threads", "loyalty")
    done.set()
    reader.join()
    assert not failed and found == sorted(found) and set(found) <= set(range(1, 8))


def test_a_table_of_other_columns_is_made_anew(spark):
    create_database(spark, "other_columns")
    replace_table(spark.range(3), "other_columns", "free")
    replace_table(spark.range(4).withColumn("more", F.lit("x")), "other_columns", "free")
    assert spark.table("other_columns.free").columns == ["id", "more"]


def test_a_replacement_that_breaks_off_leaves_the_old_rows(spark):
    """The next replacement clears what it wrote."""
    create_database(spark, "broken_off")
    replace_table(numbers(spark, 3), "broken_off", "loyalty")
    bad = numbers(spark, 3).withColumn("points_balance", F.raise_error(F.lit("gone")).cast("long"))
    with pytest.raises(Exception, match="gone"):
        replace_table(bad, "broken_off", "loyalty")
    assert spark.table("broken_off.loyalty").count() == 3
    home = Path(sinks.location(spark, "broken_off", "loyalty").removeprefix("file:")).parent
    for n in (4, 5):
        replace_table(numbers(spark, n), "broken_off", "loyalty")
    assert len(list(home.iterdir())) == 2 and spark.table("broken_off.loyalty").count() == 5


def test_weekly_log_replaces_only_its_week(spark, tmp_path):
    def log(week, shifted):
        return spark.createDataFrame(
            [(week, shifted, 0.1, True)],
            "week long, customers_shifted long, migration_rate double, stability_pass boolean",
        )

    for week, shifted in ((1, 5), (2, 6), (1, 7)):
        write_week(log(week, shifted), str(tmp_path / "log"))
    found = spark.read.parquet(str(tmp_path / "log")).orderBy("week").collect()
    assert [(r.week, r.customers_shifted) for r in found] == [(1, 7), (2, 6)]


def test_csv_export_keeps_order(spark, tmp_path):
    export_csv({"r": spark.range(100).orderBy(F.desc("id"))}, str(tmp_path))
    found = spark.read.option("header", True).csv(str(tmp_path / "r"))
    assert found.columns == ["id"]
    assert found.count() == 100


def test_registry(spark):
    with pytest.raises(ValueError):
        TableRegistry(spark)
    with pytest.raises(KeyError):
        TableRegistry(spark, path="/x").name("absent")
    assert TableRegistry(spark, path="/x").name("loyalty") == "/x/loyalty"


def test_the_log_has_one_entry_per_date(spark):
    create_database(spark, "broken")
    registry = TableRegistry(spark, database="broken")
    weeks = spark.createDataFrame(
        [(w, w, 0.1, True, dt.date(2024, 1, w)) for w in range(1, 6)],
        SCHEMAS["segment_migration_log"],
    )
    replace_table(weeks, "broken", "segment_migration_log")
    moved = spark.createDataFrame([(7, 0.2, False)], "customers_shifted long, migration_rate double, stability_pass boolean")
    for _ in range(2):
        refresh._log_migration(registry, moved, dt.date(2024, 1, 6))
    log = registry.read("segment_migration_log").orderBy("week").collect()
    assert [(r.week, r.customers_shifted) for r in log] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 7)]


def test_whole_refresh(spark, tmp_path):
    registry = TableRegistry(spark, database="weekly")
    paths = {}
    for name, df in sample_tables(spark, DATA).items():
        if name != "segment_assignments":
            paths[name] = str(tmp_path / name)
            conform(df, name).write.parquet(paths[name])
    counts = {r.table_name: r.row_count for r in refresh.load_tables(registry, paths).collect()}
    assert counts == {name: spark.read.parquet(path).count() for name, path in paths.items()}
    early, late = dt.date(2001, 6, 1), dt.date(2001, 8, 1)
    assert refresh.refresh_features(registry, early) > 100
    model_path = str(tmp_path / "model")
    refresh.refresh_model(registry, model_path, restarts=2)
    customers = refresh.refresh_assignments(registry, model_path, early)
    assert customers == registry.read("customer_features").count()
    assert "latest_migration" not in refresh.drift_tables(registry)
    for _ in range(2):  # the second time as after a failure
        refresh.refresh_features(registry)
        refresh.refresh_assignments(registry, model_path)
    log = registry.read("segment_migration_log").orderBy("week").collect()
    assert [(r.week, r.refresh_date) for r in log] == [(1, late)]
    assert log[0].customers_shifted > 0
    assert refresh.refresh_holdout(registry) > 0
    tests = {name: df.collect() for name, df in refresh.holdout_tests(registry).items()}
    assert len(tests) == 6 and all(tests.values())
    refresh.export_reports(registry, str(tmp_path / "reports"))
    assert len(list((tmp_path / "reports").iterdir())) == 9
    checks = refresh.drift_tables(registry)
    assert checks["new_customers"].first().eligible_unassigned == 0
    assert checks["latest_migration"].first().week == 1
    assert "pct_change" in checks["segment_distribution"].columns
    drifted = {r.feature: r for r in checks["feature_drift"].collect()}
    assert drifted["days_since_last_purchase"].mean_after != drifted["days_since_last_purchase"].mean_before
    for name in ("customer_features", "customer_features_processed", "segment_assignments"):
        assert registry.read(name).columns == SCHEMAS[name].names
    scale = spark.table(f"weekly.{refresh.SCALE_TABLE}").first()
    assert scale["avg_basket_size"].deviation > 0
    before = registry.read("customer_features_processed").collect()
    refresh.refresh_features(registry, early, refit_scale=False)
    assert spark.table(f"weekly.{refresh.SCALE_TABLE}").first() == scale
    assert registry.read("customer_features_processed").collect() != before


def test_model_review(spark, tmp_path):
    registry = TableRegistry(spark, database="review")
    paths = {}
    for name in refresh.FEATURE_TABLES:
        paths[name] = str(tmp_path / name)
        conform(sample_tables(spark, DATA)[name], name).write.parquet(paths[name])
    refresh.load_tables(registry, paths)
    refresh.refresh_features(registry)
    found = {name: df.collect() for name, df in refresh.review_model(registry, ks=(2, 3), restarts=1).items()}
    assert [r.k for r in found["k_selection"]] == [2, 3]
    assert len(found["method_comparison"]) == 6 and found["summary"]


def test_model_round_trip_and_numbering(spark, tmp_path):
    from basketlens.operators.features import customer_features
    from basketlens.sources.sinks import cut_lineage

    features = cut_lineage(customer_features(sample_tables(spark, DATA)))
    model = fit_segmentation(features, restarts=3)
    save_model(model, str(tmp_path / "m"))
    again = score(load_model(str(tmp_path / "m")), features)
    scored = score(model, features)
    assert scored.exceptAll(again).count() == 0
    means = scored.groupBy("segment_id").agg(F.avg("avg_basket_size").alias("m"))
    ordered = [r.m for r in means.orderBy("segment_id").collect()]
    assert len(ordered) == 5
    assert ordered == sorted(ordered)
