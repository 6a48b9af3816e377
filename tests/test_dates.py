"""Dates, ranges and the R1 rewrite."""

import datetime as dt

from pyspark.sql import functions as F

from gapledger.functions.dates import (closed_range, day_diff, half_open, month_diff, open_range,
                                       period, period_ceil, period_in_range, shift_months)


def test_month_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2018, 1, 31), dt.date(2018, 2, 1)),
                                (dt.date(2018, 2, 1), dt.date(2018, 2, 28)),
                                (dt.date(2018, 3, 15), dt.date(2017, 12, 1))], "a date, b date")
    assert [r.m for r in df.select(month_diff("a", "b").alias("m")).collect()] == [1, 0, -3]


def test_day_diff_and_period(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 31, 23, 59), dt.datetime(2018, 2, 27, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(day_diff("a", "b").alias("d"), period("a", "month").alias("m"),
                  period("b", "week").alias("w"), period("a", "day").alias("dd")).first()
    assert r.d == 27 and r.m == dt.date(2018, 1, 1) and r.w == dt.date(2018, 2, 26) and r.dd == dt.date(2018, 1, 31)


def test_range_bounds(spark):
    rows = [(dt.datetime(2018, 8, 1),), (dt.datetime(2018, 8, 31, 12),), (dt.datetime(2018, 9, 1),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    n = lambda c: df.where(c).count()
    assert n(half_open("t", "2018-08-01", "2018-09-01")) == 2
    assert n(closed_range("t", "2018-08-01", "2018-08-31")) == 1  # midnight upper bound loses the day
    assert n(open_range("t", "2018-08-01", "2018-09-01")) == 1


def test_period_ceil():
    assert period_ceil("2018-08-01", "month") == dt.datetime(2018, 8, 1)
    assert period_ceil("2018-08-02", "month") == dt.datetime(2018, 9, 1)
    assert period_ceil("2018-12-02", "month") == dt.datetime(2019, 1, 1)
    assert period_ceil("2018-11-02", "quarter") == dt.datetime(2019, 1, 1)
    assert period_ceil("2018-08-02 10:00:00", "day") == dt.datetime(2018, 8, 3)
    assert shift_months("2018-01-31", 1) == dt.date(2018, 2, 28)


def test_period_in_range_equals_truncated_filter(spark):
    base = dt.datetime(2018, 1, 1)
    rows = [(base + dt.timedelta(hours=7 * i),) for i in range(2000)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    for unit in ("day", "week", "month", "quarter", "year"):
        for a, b in [("2018-02-01", "2018-05-01"), ("2018-02-13", "2018-05-17 06:00:00")]:
            lo, hi = dt.datetime.fromisoformat(a), dt.datetime.fromisoformat(b)
            want = df.where((period("t", unit) >= F.lit(lo)) & (period("t", unit) < F.lit(hi))).count()
            got = df.where(period_in_range("t", unit, a, b)).count()
            assert got == want, (unit, a, b)


def test_r1_filter_reaches_parquet(spark, base):
    li = spark.read.parquet(f"{base}/lineitem.parquet")
    plan = li.where(period_in_range("l_shipdate", "month", "1996-01-01", "1996-03-01")) \
             ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_impossible_date_literal_raises(spark):
    import pytest
    from gapledger.functions.dates import ts_lit
    df = spark.range(1)
    with pytest.raises(Exception):
        df.select(ts_lit("2018-04-31")).collect()
    with pytest.raises(Exception):
        df.select(ts_lit("2018-04-3-")).collect()
