from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickmill.functions import columns as C
from clickmill.functions.calendar import date_spine


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize(
    "day, dow, weekend, week, month, name",
    [
        ("2024-01-06", 6, True, "2024-01-01", "2024-01-01", "Saturday "),
        ("2024-01-07", 0, True, "2024-01-01", "2024-01-01", "Sunday   "),
        ("2024-01-08", 1, False, "2024-01-08", "2024-01-01", "Monday   "),
        ("2024-02-29", 4, False, "2024-02-26", "2024-02-01", "Thursday "),
        ("2024-12-31", 2, False, "2024-12-30", "2024-12-01", "Tuesday  "),
    ],
)
def test_calendar(spark, day, dow, weekend, week, month, name):
    d = C.day(day)
    got = one(
        spark, C.day_of_week(d), C.is_weekend(d), C.start_of_week(d), C.start_of_month(d), C.day_name(d)
    )
    assert got == (dow, weekend, date.fromisoformat(week), date.fromisoformat(month), name)


def test_days_between_and_spine(spark):
    assert one(spark, C.days_between(C.day("2024-02-28"), C.day("2024-03-01"))) == (2,)
    days = [r[0] for r in date_spine(spark, "2024-02-28", "2024-03-01").orderBy("date_day").collect()]
    assert days == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert date_spine(spark, "2024-03-01", "2024-02-28").count() == 0


@pytest.mark.parametrize(
    "num, den, places, factor, want",
    [
        ("1", "8", 2, 1, 0.13),
        ("2.675", "1", 2, 1, 2.68),
        ("33.335", "1", 2, 1, 33.34),
        ("4970.65", "2", 2, 1, 2485.33),
        ("-1", "8", 2, 1, -0.13),
        ("1", "3", 4, 100, 33.3333),
        ("2", "3", 2, 100, 66.67),
        ("5", "0", 2, 1, 0.0),
        ("5", "-1", 2, 1, 0.0),
    ],
)
def test_safe_divide(spark, num, den, places, factor, want):
    columns = [F.lit(Decimal(v)) for v in (num, den)]
    assert one(spark, C.safe_divide(*columns, places, factor)) == (want,)


def test_safe_divide_null_denominator_is_zero(spark):
    assert one(spark, C.safe_divide(F.lit(1), F.lit(None).cast("int"))) == (0.0,)


def test_time_of_day(spark):
    hours = spark.range(24).select(C.time_of_day(F.col("id")).alias("t"))
    want = ["night"] * 6 + ["morning"] * 6 + ["lunch"] * 3 + ["afternoon"] * 4 + ["evening"] * 4 + ["night"]
    assert [r[0] for r in hours.collect()] == want
    assert one(spark, C.time_of_day(F.lit(None).cast("int"))) == ("night",)


@pytest.mark.parametrize(
    "purchases, days, views, idle, want",
    [
        (10, 15, 0, 0, "power_user"),
        (10, 14, 0, 0, "regular"),
        (9, 15, 0, 0, "regular"),
        (3, 5, 0, 99, "regular"),
        (3, 4, 0, 0, "casual_buyer"),
        (1, 99, 99, 99, "casual_buyer"),
        (0, 1, 10, 99, "window_shopper"),
        (0, 1, 9, 31, "churned"),
        (0, 1, 9, 30, "new_user"),
    ],
)
def test_user_segment(spark, purchases, days, views, idle, want):
    assert one(spark, C.user_segment(*map(F.lit, (purchases, days, views, idle)))) == (want,)


@pytest.mark.parametrize(
    "age, idle, want",
    [(7, 0, "new"), (8, 7, "active"), (8, 8, "at_risk"), (99, 30, "at_risk"), (99, 31, "dormant")],
)
def test_lifecycle_stage(spark, age, idle, want):
    assert one(spark, C.lifecycle_stage(F.lit(age), F.lit(idle))) == (want,)


def test_label(spark):
    assert one(spark, C.label(F.lit("add_to_cart"))) == ("Add To Cart",)


@pytest.mark.parametrize(
    "num, den, want",
    [(4999999999, 10**12, 0.0), (5000000000, 10**12, 0.01), (-4999999999, 10**12, 0.0), (-1, 200, -0.01),
     (10**17, 10**16, 10.0), (1, 3, 0.33), (2, 3, 0.67)],
)
def test_ratios_are_rounded_once(spark, num, den, want):
    assert one(spark, C.safe_divide(F.lit(num), F.lit(den))) == (want,)
