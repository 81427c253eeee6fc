"""Reading, checking and conforming tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from basketlens.sources.schemas import SCHEMAS, date_columns, required_columns


class RequiredColumnError(ValueError):
    """A column that must be filled holds nulls."""


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether ``database.table`` exists."""
    return spark.catalog.tableExists(name)


class TableRegistry:
    """The eleven tables by name, as tables of a database or directories below a path.

    With ``buckets`` the tables per customer of a database are bucketed by customer.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str | None = None,
        path: str | None = None,
        buckets: int | None = None,
    ):
        if (database is None) == (path is None):
            raise ValueError("give either a database or a path")
        self.spark = spark
        self.database = database
        self.path = path
        self.buckets = buckets

    def name(self, table: str) -> str:
        if table not in SCHEMAS:
            raise KeyError(f"unknown table {table!r}; known: {', '.join(SCHEMAS)}")
        return f"{self.database}.{table}" if self.database else f"{self.path}/{table}"

    def read(self, table: str) -> DataFrame:
        if self.database:
            return self.spark.table(self.name(table))
        return read_files(self.spark, table, self.name(table), "parquet")


def text_to_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn text columns into dates; unreadable text becomes null."""
    present = [c for c in columns if c in df.columns]
    is_text = {f.name: isinstance(f.dataType, StringType) for f in df.schema.fields}
    return df.withColumns({c: F.try_to_date(c) for c in present if is_text[c]})


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns in order, with their types; absent ones become null.

    A required column must be present. Text dates are read leniently, every other
    cast is strict.
    """
    schema = SCHEMAS[table]
    missing = [c for c in required_columns(table) if c not in df.columns]
    if missing:
        raise RequiredColumnError(f"{table}: required columns absent: {', '.join(missing)}")
    df = text_to_dates(df, date_columns(table))
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_files(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Typed scan of files with the declared schema, never an inferred one.

    Text formats read date columns as text first, so that one bad date does not fail
    the scan or discard its row.
    """
    if fmt == "parquet":
        return spark.read.schema(SCHEMAS[table]).parquet(path)
    lenient = StructType()
    for field in SCHEMAS[table].fields:
        is_date = isinstance(field.dataType, DateType)
        lenient = lenient.add(field.name, StringType() if is_date else field.dataType)
    reader = spark.read.schema(lenient).option("mode", "FAILFAST")
    if fmt == "csv":
        reader = reader.option("header", True)
    return conform(reader.format(fmt).load(path), table)


REASONS = ("unreadable row", "unreadable date", "required column empty")


def read_checked(spark: SparkSession, table: str, path: str, fmt: str = "csv") -> DataFrame:
    """The rows of text files with what is wrong with each: the declared columns, and
    ``reason``, ``detail``, ``record`` and ``file`` (S1, S2).

    ``reason`` is null for a good row. A row that cannot be read as its types, whose date has
    text that is no date, or whose required column is empty has a reason; ``detail`` names
    the column where there is one, ``record`` is the text of an unreadable row.
    """
    lenient = StructType()
    for field in SCHEMAS[table].fields:
        is_date = isinstance(field.dataType, DateType)
        lenient = lenient.add(field.name, StringType() if is_date else field.dataType)
    reader = spark.read.schema(lenient.add("_record", StringType()))
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record")
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    raw = reader.format(fmt).load(path).withColumn("file", F.col("_metadata.file_path"))
    dates = [c for c in date_columns(table) if c in lenient.names]
    no_dates = [F.when(F.col(c).isNotNull() & F.try_to_date(c).isNull(), F.lit(c)) for c in dates]
    empty = [F.when(F.col(c).isNull(), F.lit(c)) for c in required_columns(table)]
    bad_date, missing = F.coalesce(*no_dates, F.lit(None)), F.coalesce(*empty, F.lit(None))
    unreadable = F.col("_record").isNotNull()
    checked = raw.select(
        "*",
        F.when(unreadable, REASONS[0]).when(bad_date.isNotNull(), REASONS[1]).when(missing.isNotNull(), REASONS[2]).alias("reason"),
        F.when(~unreadable, F.coalesce(bad_date, missing)).alias("detail"),
    )
    columns = conform(checked, table).columns
    typed = text_to_dates(checked, dates)
    return typed.select(*columns, "reason", "detail", F.col("_record").alias("record"), "file")


def split_rejects(checked: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """The good rows, and the bad ones as (table_name, reason, detail, record, file).

    The record of a row that could be read but is bad is its columns as JSON.
    """
    columns = SCHEMAS[table].names
    good = checked.where(F.col("reason").isNull()).select(*columns)
    as_text = F.coalesce("record", F.to_json(F.struct(*columns)))
    bad = checked.where(F.col("reason").isNotNull())
    return good, bad.select(F.lit(table).alias("table_name"), "reason", "detail", as_text.alias("record"), "file")


def required_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per required column with its number of nulls (S3), one pass per table."""
    parts = []
    for table, df in tables.items():
        columns = required_columns(table)
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        parts.append(
            counts.unpivot([], columns, "column_name", "null_count").select(
                F.lit(table).alias("table_name"), "column_name", "null_count"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def guard_required(df: DataFrame, table: str) -> DataFrame:
    """Refuse nulls in required columns while the rows stream through, without a pass of its own."""

    def checked(column: str) -> Column:
        message = F.lit(f"{table}.{column} is required but null")
        return F.coalesce(F.col(column), F.raise_error(message).cast(df.schema[column].dataType))

    return df.withColumns({c: checked(c) for c in required_columns(table)})
