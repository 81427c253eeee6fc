"""Exact ranks against brute force, with one group holding a third of the rows."""

from __future__ import annotations

import math
import random
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from basketlens.functions.numeric import round_to
from basketlens.functions.ranks import (
    discrete_median,
    from_ordered_bits,
    in_cents,
    lower_median,
    midpoint_median,
    ordered_bits,
    value_at_rank,
)


def _rows(seed: int) -> list[tuple[str, float | None]]:
    rng = random.Random(seed)
    rows: list[tuple[str, float | None]] = []
    for i in range(40):
        for _ in range(rng.randint(1, 12)):
            rows.append((f"c{i}", round(rng.uniform(-50, 50), 2)))
    # Values close together, many of them in one bucket.
    rows += [("hot", round(100 + rng.random() * 0.4, 3)) for _ in range(len(rows) // 2)]
    rows += [("ties", 7.0)] * 9 + [("ties", 7.0005)] * 5
    rows += [("zero", v) for v in (0.0, -0.0, 1e-300, -1e300, 1e300)]
    rows += [("nulls", None), ("nulls", 3.0), ("only_null", None)]
    rng.shuffle(rows)
    return rows


def _groups(rows):
    groups: dict[str, list[float]] = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    return groups


def test_medians_match_brute_force(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "key string, value double").repartition(5)
    wanted = _groups(rows)
    low = value_at_rank(df, ["key"], "value", F.ceil(F.col("n") / 2), "m").collect()
    assert {r.key: r.m for r in low} == {k: statistics.median_low(v) for k, v in wanted.items()}
    mid = midpoint_median(df, ["key"], "value", "m").collect()
    assert {r.key: r.m for r in mid} == {k: statistics.median(v) for k, v in wanted.items()}


@pytest.mark.parametrize("rounds", [(48, 32, 16, 0), (16, 0), (0,), (60, 7, 0)])
def test_every_rank_of_whole_numbers(spark, rounds):
    rng = random.Random(5)
    values = [rng.choice((rng.randrange(-70_000, 70_000), rng.getrandbits(64) - (1 << 63), 3)) for _ in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "value long")
    for rank in (1, 2, 17, 39, 40):
        assert value_at_rank(df, [], "value", F.lit(rank), "v", rounds=rounds).first().v == sorted(values)[rank - 1]
    assert value_at_rank(df, [], "value", F.lit(41), "v", rounds=rounds).count() == 0


def test_global_rank_and_integers(spark):
    df = spark.range(1, 102).select(F.col("id").alias("value"))
    assert lower_median(df, [], "value", "m").first().m == 51
    assert value_at_rank(df, [], "value", F.lit(7), "v").first().v == 7
    empty = df.where("value < 0")
    assert lower_median(empty, [], "value", "m").count() == 0
    assert midpoint_median(empty, [], "value", "m").count() == 0
    assert spark.range(1).select(lower_median(empty, [], "value", "m").scalar()).first()[0] is None


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (None, 1.0001), (None, 1.00015), ("a", 5.0)], "key string, value double"
    )
    found = midpoint_median(df, ["key"], "value", "m").collect()
    assert {r.key: r.m for r in found} == {None: 1.0001, "a": 5.0}


def test_medians_of_cents(spark):
    """Rounding keeps the order, so the median of cents is the median in cents."""
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.uniform(-3, 300)) for _ in range(300)] + [("d", None), ("e", 0.125), ("e", 2.675)]
    df = spark.createDataFrame(rows, "key string, amount double").withColumn("cents", in_cents("amount"))
    low = {k: statistics.median_low(v) for k, v in _groups(rows).items()}
    wanted = {k: spark.range(1).select(round_to(F.lit(v), 2)).first()[0] for k, v in low.items()}
    one_pass = df.groupBy("key").agg(discrete_median("cents").alias("m")).where("m IS NOT NULL").collect()
    rounds = lower_median(df, ["key"], "cents", "m").collect()
    assert {r.key: r.m / 100 for r in one_pass} == {r.key: r.m / 100 for r in rounds} == wanted


def test_bits_keep_order_and_value(spark):
    """The bits are those of the format, for every exponent and around every power of two."""
    values = [0.0, 5e-324, 1e-310, 2.0**-1022, 1.7976931348623157e308, math.inf, 0.1, 2 / 3]
    for exponent in range(-1074, 1024, 7):
        power = 2.0**exponent
        values += [power, math.nextafter(power, 0), math.nextafter(power, math.inf)]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "value double")
    bits = ordered_bits(F.col("value"))
    for row in df.select("value", bits.alias("b"), from_ordered_bits(bits).alias("back")).collect():
        plain = struct.unpack("<q", struct.pack("<d", abs(row.value)))[0]
        assert row.b == (-plain if row.value < 0 else plain) and row.back == row.value
    nan = spark.createDataFrame([(math.nan,)], "value double").select(bits.alias("b"), from_ordered_bits(bits).alias("back")).first()
    assert nan.b > max(struct.unpack("<q", struct.pack("<d", math.inf))) and math.isnan(nan.back)
