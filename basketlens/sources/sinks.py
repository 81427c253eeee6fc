"""Writing tables, report files and models."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketlens.sources.schemas import SCHEMAS
from basketlens.sources.tables import conform, guard_required, table_exists

#: A table's rows lie in one folder per version; the folder's name begins with the date.
VERSIONS, UNDATED = "__versions", "undated"


def replace_table(
    df: DataFrame,
    database: str,
    table: str,
    cluster_by: str | None = None,
    refresh_date: dt.date | None = None,
    buckets: int | None = None,
) -> int:
    """Replace a table by the rows of ``df`` and return how many were written.

    The rows go to a new version folder, and one ``ALTER TABLE .. SET LOCATION`` makes it the
    table: readers meet the old rows or the new ones and never no table, and a job that ends
    before leaves the old ones. The version before is kept until the next replacement, so
    ``df`` may read the table it replaces, and queries that have begun go on. Older versions
    and those of broken jobs are deleted. A table whose columns change is made anew.

    The row count is observed during the write and costs no second scan. ``cluster_by``
    sorts each written file by a column, which keeps the minimum and maximum of its row
    groups narrow; with ``buckets`` the rows are bucketed by that column, so that tables of one
    number of buckets meet without a shuffle. ``refresh_date`` is part of the folder's name, so that it changes together
    with the rows.
    """
    spark = df.sparkSession
    rows = Observation(f"rows_{table}")
    out = guard_required(conform(df, table), table) if table in SCHEMAS else df
    if buckets:
        out = out.repartition(buckets, cluster_by)
    elif cluster_by:
        out = out.repartition(cluster_by).sortWithinPartitions(cluster_by)
    out = out.observe(rows, F.count(F.lit(1)).alias("rows"))
    home = f"{spark.catalog.getDatabase(database).locationUri}/{table}{VERSIONS}"
    version = f"{home}/{refresh_date or UNDATED}_{uuid.uuid4().hex}"
    name, before = f"`{database}`.`{table}`", location(spark, database, table)
    writer = out.write.format("parquet")
    if not buckets:
        writer.save(version)
    else:
        # Only a table can be bucketed; dropping this one leaves its files.
        written = f"{database}.{table}__written"
        spark.sql(f"DROP TABLE IF EXISTS {written}")
        writer.bucketBy(buckets, cluster_by).sortBy(cluster_by).option("path", version).saveAsTable(written)
        spark.sql(f"DROP TABLE {written}")
    shape = [*out.dtypes, ("buckets", str(buckets))]
    if before is not None and shape != _shape(spark, database, table):
        spark.sql(f"DROP TABLE {name}")
        before = None
    if before is None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
        layout = f"CLUSTERED BY ({cluster_by}) SORTED BY ({cluster_by}) INTO {buckets} BUCKETS" if buckets else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION '{version}'")
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.catalog.refreshTable(f"{database}.{table}")
    _delete_others(spark, home, keep=(version, before))
    return rows.get["rows"]


def _shape(spark: SparkSession, database: str, table: str) -> list[tuple[str, str]]:
    """A table's columns with their types, and its number of buckets."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{table}`").collect()
    buckets = next((row["data_type"] for row in rows if row["col_name"] == "Num Buckets"), "None")
    return [*spark.table(f"{database}.{table}").dtypes, ("buckets", buckets)]


def location(spark: SparkSession, database: str, table: str) -> str | None:
    """The folder a table's rows lie in; None if there is no such table."""
    if not table_exists(spark, f"{database}.{table}"):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{table}`").collect()
    return next(row["data_type"] for row in rows if row["col_name"] == "Location")


def _delete_others(spark: SparkSession, home: str, keep: tuple[str | None, ...]) -> None:
    """Delete the version folders that are not among the last parts of the paths in ``keep``."""
    kept = {path.rstrip("/").rpartition("/")[2] for path in keep if path}
    place = spark._jvm.org.apache.hadoop.fs.Path(home)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(place):
        if status.getPath().getName() not in kept:
            store.delete(status.getPath(), True)


def stored_date(spark: SparkSession, database: str, table: str) -> dt.date | None:
    """The refresh date stored with a table, if it has one."""
    place = location(spark, database, table)
    date = place.rstrip("/").rpartition("/")[2].partition("_")[0] if place else UNDATED
    try:
        return dt.date.fromisoformat(date)
    except ValueError:
        return None


def keep_previous(spark: SparkSession, database: str, table: str, refresh_date: dt.date) -> None:
    """Copy a table to ``TABLE_previous`` unless it is already that of ``refresh_date``.

    Called before the table is replaced; a repeated refresh leaves the copy alone.
    """
    date = stored_date(spark, database, table)
    if date is not None and date != refresh_date:
        replace_table(spark.table(f"{database}.{table}"), database, f"{table}_previous", refresh_date=date)


def write_week(df: DataFrame, path: str) -> None:
    """Add or replace the weeks of a migration log, one partition directory per week."""
    (
        conform(df, "segment_migration_log")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("week")
        .parquet(path)
    )


def export_csv(reports: dict[str, DataFrame], directory: str) -> None:
    """One CSV directory with header per report; the files keep the report's row order."""
    for name, report in reports.items():
        report.write.mode("overwrite").option("header", True).csv(f"{directory}/{name}")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    single-machine session without that setting gets a temporary one.
    """
    spark = df.sparkSession
    _ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that all executors share.

    The cluster names it in ``spark.checkpoint.dir``. A session without that setting,
    such as a test, gets a temporary one, which only works where driver and executors
    share their disk.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="basketlens-checkpoint-"))
    return context.getCheckpointDir()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Set the folder, and have what this application puts there deleted at its end."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(spark))
    if not getattr(context, "_basketlens_deletes", False):
        own = spark._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
        own.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(own)
        context._basketlens_deletes = True
