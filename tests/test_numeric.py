"""Exact sums and rounding against Python's decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from periodgrid.functions.numeric import fixed_sum, round_value, rounded_mean, rounded_sum

CENTS = st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=40)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=CENTS)
def test_sum_and_rounding(spark, cents):
    df = spark.createDataFrame([(c / 10000,) for c in cents], "v double").repartition(3)
    total = df.agg(fixed_sum(F.col("v"), 4).alias("t")).first().t
    assert total == sum((Decimal(c).scaleb(-4) for c in cents), Decimal(0))
    got = sorted(r.r for r in df.select(round_value(F.col("v"), 2, 4).alias("r")).collect())
    want = [float(Decimal(c).scaleb(-4).quantize(Decimal("0.01"), ROUND_HALF_UP)) for c in cents]
    assert got == sorted(want)


def test_sum_beyond_a_bigint(spark):
    df = spark.range(3000).select(F.lit(9.0e13).alias("v"))
    assert df.agg(fixed_sum(F.col("v"), 2).alias("t")).first().t == Decimal("270000000000000000.00")


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (1.25, "b"), (None, "b")], "v double, k string")
    rows = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(
        rounded_sum(F.col("v"), 2, 2).alias("s"), rounded_mean(F.col("v"), 2, 2).alias("m")).collect()}
    assert rows == {"a": (None, None), "b": (1.25, 1.25)}


@pytest.mark.parametrize("value", [float("inf"), float("nan"), 1e17])
def test_no_silent_overflow(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    with pytest.raises(PySparkException, match="fixed-point"):
        df.agg(fixed_sum(F.col("v"), 2)).collect()


def test_plain_rounding_keeps_infinity(spark):
    df = spark.createDataFrame([(float("inf"),), (2.675,)], "v double")
    assert sorted(r.r for r in df.select(round_value(F.col("v")).alias("r")).collect()) == [2.68, float("inf")]
