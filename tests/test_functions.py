from datetime import datetime
from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from storelens.functions.dates import (add_days, calendar_days_between, month_label,
                                       whole_days_between)
from storelens.functions.numeric import exact_mean, half_up_ratio, percent, wide_sum


def ref_half_up(num, den, scale, factor=1):
    x = Fraction(num * factor, den) * 10 ** scale
    q = (abs(x.numerator) * 2 + x.denominator) // (2 * x.denominator)
    return (q if x >= 0 else -q) / 10 ** scale


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-9 * 10**18, 9 * 10**18), st.integers(1, 10**6)),
                min_size=50, max_size=50))
def test_half_up_ratio_matches_exact_rational(spark, pairs):
    pairs += [(1, 200), (-1, 200), (5, 1000), (1005, 100000), (0, 7), (2, 3)]
    # a quotient has to fit a bigint, the scaled numerator does not
    pairs = [(n, d if abs(n) < 10**14 else d * 10**6) for n, d in pairs]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", half_up_ratio("n", "d", 2).alias("r"),
                    percent("n", "d", 1).alias("p")).collect()
    for r in got:
        assert r.r == ref_half_up(r.n, r.d, 2)
        assert r.p == ref_half_up(r.n, r.d, 1, factor=100)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1), min_size=1, max_size=40))
def test_wide_sum_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert df.agg(wide_sum("v").alias("s")).first().s == sum(values)


def test_means_and_shares_of_huge_sums(spark):
    big = 10 ** 19                                    # cents, beyond a bigint
    df = spark.createDataFrame([(Decimal(big), 1000), (Decimal(-big - 5), 1000)], "t decimal(38,0), n long")
    got = [r.m for r in df.select(exact_mean("t", "n", 2, unit_scale=2).alias("m")).collect()]
    assert got == [1e14, -1e14]
    share = df.select(percent("t", F.lit(Decimal(big)).cast("decimal(38,0)"), 2).alias("p")).collect()
    assert [r.p for r in share] == [100.0, -100.0]


def test_half_up_zero_divisor(spark):
    df = spark.createDataFrame([(1, 0)], "n long, d long")
    assert df.select(half_up_ratio("n", "d", 2).alias("r")).first().r is None


def test_whole_vs_calendar_days(spark):
    # mf_days: 23:00 Jan 1 -> 01:00 Jan 3, reversed, NULL end (trap T4)
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1, 23), datetime(2020, 1, 3, 1)),
         (datetime(2020, 1, 3, 1), datetime(2020, 1, 1, 23)),
         (datetime(2020, 1, 1, 23), None)],
        "a timestamp_ntz, b timestamp_ntz")
    got = [(r.w, r.c) for r in df.select(whole_days_between("b", "a").alias("w"),
                                         calendar_days_between("b", "a").alias("c")).collect()]
    assert got == [(1, 2), (-1, -2), (None, None)]


def test_add_days_keeps_time_and_month_label(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 31, 13, 5), 2016, 9)],
                               "t timestamp_ntz, y int, m int")
    r = df.select(add_days("t", 30).alias("t2"), month_label("y", "m").alias("l")).first()
    assert r.t2 == datetime(2020, 3, 1, 13, 5)
    assert r.l == "2016-09"
