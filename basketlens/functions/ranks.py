"""Exact order statistics by counting, without bringing a group's rows together.

Two ways, both with counts that combine on the map side and neither moving rows:

* ``discrete_median`` is one aggregate beside others. Its state per group is a count for each
  different value, so it is for values of a fixed grain such as whole cents or counts.
* ``value_at_rank`` takes any numbers and any rank, for a handful of groups. It is a radix
  selection: a number is 64 bits in its order, and each round fixes the next 16 bits of the
  wanted value. A round counts the values that have the bits so far by their next bits; a
  group has 65,536 counts in a round at most, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from basketlens.functions.numeric import round_to

#: How many bits a value still lacks after each round. Whole numbers below 2 ** 32, such as
#: cents or counts, have few different upper parts, which one round settles.
ALL_BITS = (48, 32, 16, 0)
SMALL_NUMBERS = (16, 0)

#: Fixed values of the double format: bits of the fraction, exponent bias, exponent of infinity.
FRACTION_BITS = 52
BIAS = 1023
INFINITE = 2047 << FRACTION_BITS
NOT_A_NUMBER = INFINITE + (1 << (FRACTION_BITS - 1))


def _two_to(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent)


def ordered_bits(number: Column) -> Column:
    """The bits of a double as a long that orders as the doubles do; NaN is the largest.

    Every step is exact: powers of two only move the exponent.
    """
    size = F.abs(number)
    fraction = F.lit(float(1 << FRACTION_BITS))
    guess = F.floor(F.log2(size))
    exponent = (
        F.when(_two_to(guess) > size, guess - 1)
        .when(_two_to(guess + 1) <= size, guess + 1)
        .otherwise(guess)
    )
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    scaled = (size * _two_to(-exponent) - 1) * fraction
    usual = (exponent + BIAS) * F.lit(1 << FRACTION_BITS) + scaled.cast("long")
    bits = F.when(size == F.lit(float("inf")), INFINITE).when(size < F.lit(2.0**-1022), tiny).otherwise(usual)
    return F.when(F.isnan(number), NOT_A_NUMBER).when(number < 0, -bits).otherwise(bits)


def from_ordered_bits(bits: Column) -> Column:
    """The double of :func:`ordered_bits`."""
    size = F.abs(bits)
    exponent = F.shiftright(size, FRACTION_BITS)
    part = (size % F.lit(1 << FRACTION_BITS)).cast("double")
    tiny = part * F.lit(2.0**-537) * F.lit(2.0**-537)
    usual = (F.lit(1.0) + part / F.lit(float(1 << FRACTION_BITS))) * _two_to(exponent - BIAS)
    value = F.when(size == INFINITE, F.lit(float("inf"))).when(exponent == 0, tiny).otherwise(usual)
    return F.when(bits == NOT_A_NUMBER, F.lit(float("nan"))).when(bits < 0, -value).otherwise(value)


def _of_group(chosen: DataFrame, keys: Sequence[str]) -> Column:
    """What a round chose for a row's group: a scalar subquery, one entry per group."""
    fact = F.struct("bits", "position", "n")
    if not keys:
        return chosen.select(fact).scalar()
    entries = F.map_from_entries(F.collect_list(F.struct(F.struct(*keys), fact)))
    return F.try_element_at(chosen.agg(entries).scalar(), F.struct(*keys))


def _choose(counts: DataFrame, keys: Sequence[str], position: Column) -> DataFrame:
    """Per group the bits under which its wanted rank falls, and the rank among those."""
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("bits"))

    def step(state: Column, count: Column) -> Column:
        through = state["before"] + count["rows"]
        here = state["bits"].isNull() & (through >= F.col("position"))
        return F.struct(
            F.when(here | state["bits"].isNotNull(), state["before"]).otherwise(through).alias("before"),
            F.when(here, count["bits"]).otherwise(state["bits"]).alias("bits"),
        )

    found = (
        counts.groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.struct("bits", "rows"))).alias("counts"),
            F.sum("rows").alias("total"),
            F.first("n").alias("n"),
            F.first("position").alias("position"),
        )
        .withColumn("n", F.coalesce("n", "total"))
        .withColumn("position", F.coalesce("position", position.cast("long")))
        .where("position BETWEEN 1 AND total")
        .withColumn("hit", F.aggregate("counts", start, step))
    )
    return found.select(*keys, "n", F.col("hit.bits").alias("bits"), (F.col("position") - F.col("hit.before")).alias("position"))


def value_at_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rank: Column,
    name: str,
    weight: str | None = None,
    rounds: Sequence[int] = ALL_BITS,
) -> DataFrame:
    """For each group the value at a 1-based rank, ascending, as column ``name``.

    ``rank`` is an expression over ``n``, the number of non-null values of the group. Groups
    without values, or whose rank lies outside them, do not appear. Groups are a handful of
    segments or features, whose keys may be null; without keys there is one group.

    ``weight`` names a column that says how often a value stands for itself, for values that
    are counted already. ``rounds`` has the bits left after each round, the last being 0.
    """
    keys = list(keys)
    kind = df.schema[value].dataType
    whole = isinstance(kind, IntegralType)
    bits = F.col(value).cast("long") if whole else ordered_bits(F.col(value).cast("double"))
    times = F.lit(1) if weight is None else F.col(weight)
    rows = df.where(F.col(value).isNotNull()).select(*keys, bits.alias("bits"), times.alias("rows"))
    chosen, known = None, 64
    for left in rounds:
        now = rows
        if chosen is None:
            now = now.withColumns({c: F.lit(None).cast("long") for c in ("n", "position")})
        else:
            # The subquery stands in one column, so it is planned once.
            now = (
                now.withColumn("chosen", _of_group(chosen, keys))
                .where(F.shiftright("bits", known) == F.col("chosen.bits"))
                .select(*keys, "bits", "rows", "chosen.n", "chosen.position")
            )
        counts = (
            now.withColumn("bits", F.shiftright("bits", left))
            .groupBy(*keys, "bits")
            .agg(F.sum("rows").alias("rows"), F.first("n").alias("n"), F.first("position").alias("position"))
        )
        chosen, known = _choose(counts, keys, rank), left
    result = F.col("bits") if whole else from_ordered_bits(F.col("bits"))
    return chosen.select(*keys, result.cast(kind).alias(name))


def lower_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The observed value in the middle, the lower one of an even number, of small whole numbers.

    The values are counted first, so that the rounds read counts and not rows. They select by
    ``number``, a result of that aggregate: a filter on its key would move below it, and each
    round would count the rows anew.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("rows"), F.first(value).alias("number"))
    )
    return value_at_rank(counts, keys, "number", F.ceil(F.col("n") / F.lit(2.0)), name, "rows", SMALL_NUMBERS)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on the keys, treating nulls as equal."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    joined = left.join(renamed, same, how)
    return joined.drop(*[f"_right_{key}" for key in keys])


def midpoint_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The middle value, or the mean of the two middle values.

    The upper one is the lower one or the least value above it, which one more pass tells.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("value")).where("value IS NOT NULL")
    lower = value_at_rank(rows, keys, "value", F.ceil(F.col("n") / F.lit(2.0)), "lower")
    if keys:
        entries = F.map_from_entries(F.collect_list(F.struct(F.struct(*keys), "lower")))
        middle = F.try_element_at(lower.agg(entries).scalar(), F.struct(*keys))
    else:
        middle = lower.scalar()
    pair = (
        rows.withColumn("lower", middle)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            F.max("lower").alias("lower"),
            F.count_if(F.col("value") <= F.col("lower")).alias("through"),
            F.min(F.when(F.col("value") > F.col("lower"), F.col("value"))).alias("above"),
        )
        .where("n > 0")
    )
    upper = F.when(F.col("through") > F.floor(F.col("n") / F.lit(2.0)), F.col("lower")).otherwise(F.col("above"))
    return pair.select(*keys, ((F.col("lower") + upper) / F.lit(2.0)).alias(name))


def discrete_median(value: str) -> Column:
    """An aggregate: the observed value in the middle, the lower one of an even number.

    Its state has a count per different value of the group: at most as many as there are whole
    numbers in the values' range, which does not grow with the rows. ``value`` is a column of
    whole numbers.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value})").cast("long")


def in_cents(amount: str | Column) -> Column:
    """An amount as a whole number of cents, half a cent up; medians of cents are medians of amounts in cents."""
    return F.round(round_to(F.col(amount) if isinstance(amount, str) else amount, 2) * 100).cast("long")
