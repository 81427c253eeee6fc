"""Daily sums kept beside the base tables, so that a refresh reads new days only.

Base rows and their sums lie in directories partitioned by day. A load brings whole days: it
overwrites the partitions of these days and of no others, and then sums up these days again.
Features read the sums, which have a row per customer, category and day, per customer, day
and amount, and per customer, session and day; the base rows of earlier days are not
touched. Loading the same days again replaces them, so a load that broke off is repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from basketlens.operators.features import daily_cents, daily_purchases, daily_sessions
from basketlens.sources.schemas import SCHEMAS
from basketlens.sources.tables import conform, guard_required

DATES = {"transactions": "transaction_date", "web_events": "event_date"}
SUMS = {
    "transactions": {"daily_purchases": daily_purchases, "daily_cents": daily_cents},
    "web_events": {"daily_sessions": daily_sessions},
}
#: The partition column; the date itself stays a column of the files.
DAY = "day"


class DailyStore:
    """Base rows and daily sums below a path that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _write(self, df: DataFrame, name: str, date: str) -> None:
        """Overwrite the days of ``df``; AQE deals a large day to several files."""
        (
            df.withColumn(DAY, F.col(date))
            .hint("rebalance", DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(f"{self.path}/{name}")
        )

    def base_rows(self, table: str, days: Iterable[dt.date | None] | None = None) -> DataFrame:
        """The stored rows of a base table, of all days or of some; None is the unknown day."""
        schema = StructType([*SCHEMAS[table].fields, StructField(DAY, DateType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        if days is not None:
            rows = rows.where(_any_day(days))
        return rows.drop(DAY)

    def load(self, rows: DataFrame, table: str) -> list[dt.date | None]:
        """Store the days of ``rows`` in place of what was stored for them; returns the days.

        The driver receives one value per day of the load.
        """
        typed = guard_required(conform(rows, table), table)
        self._write(typed, table, DATES[table])
        days = [row[0] for row in typed.select(DATES[table]).distinct().collect()]
        self.sum_up(table, days)
        return days

    def sum_up(self, table: str, days: Iterable[dt.date | None]) -> None:
        """Replace the daily sums of ``days`` by what the base rows of these days give."""
        for name, sums in SUMS[table].items():
            self._write(sums(self.base_rows(table, days)), name, DATES[table])

    def tables(self) -> dict[str, DataFrame]:
        """The daily sums, as :func:`~basketlens.operators.features.snapshot_features` reads them."""
        names = [name for sums in SUMS.values() for name in sums]
        return {name: self.spark.read.parquet(f"{self.path}/{name}").drop(DAY) for name in names}


def _any_day(days: Iterable[dt.date | None]) -> Column:
    days = list(days)
    known = [day for day in days if day is not None]
    chosen = F.col(DAY).isin(*known) if known else F.lit(False)
    return chosen | F.col(DAY).isNull() if len(known) < len(days) else chosen
