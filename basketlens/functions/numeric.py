"""Rounding, ratios and share columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def round_to(value: Column, digits: int) -> Column:
    """Round half up on the decimal value.

    Going through a decimal with eight places makes the result independent of the
    order in which the doubles behind it were summed.
    """
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """Division that yields null where the denominator is zero or null."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if digits is None else round_to(quotient, digits)


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    return round_to(F.try_divide(numerator.cast("double"), denominator.cast("double")) * 100, digits)


def with_share(
    groups: DataFrame, count: str, share: str, within: Sequence[str] = (), digits: int = 1
) -> DataFrame:
    """Add each row's percentage of the total of ``count``.

    ``groups`` must be grouped already: the window runs over group rows only.
    """
    total = F.sum(count).over(Window.partitionBy(*within))
    return groups.withColumn(share, percent(F.col(count), total, digits))


def is_true(flag: str) -> Column:
    """One where the flag is true; null counts as neither true nor false."""
    return F.coalesce(F.col(flag), F.lit(False))


def is_false(flag: str) -> Column:
    return F.coalesce(~F.col(flag), F.lit(False))
