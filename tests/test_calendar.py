import datetime as dt

from martmill.functions import calendar as K
from martmill.plans import bikeshop, jaffle


def test_spine_excludes_its_end(spark):
    days = [r[0] for r in bikeshop.dim_date(spark).orderBy("date_day").collect()]
    assert len(days) == 3652
    assert (days[0], days[-1]) == (dt.date(2020, 1, 1), dt.date(2029, 12, 30))


def test_empty_spine(spark):
    assert K.date_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 1)).count() == 0


def test_spine_over_data(spark, rows):
    df = spark.createDataFrame([(dt.date(2020, 2, 28),), (dt.date(2020, 3, 1),), (None,)], "d date")
    assert [r[0].day for r in K.spine_over(df, "d").orderBy("date_day").collect()] == [28, 29, 1]
    assert K.spine_over(df.filter("d IS NULL"), "d").count() == 0


def test_time_spine_window_is_strict_on_both_sides(spark):
    as_of = dt.date(2040, 6, 15)
    days = [r[0] for r in jaffle.time_spine_daily(spark, as_of).orderBy("date_day").collect()]
    assert days[0] == dt.date(2020, 6, 16)
    assert days[-1] == dt.date(2029, 12, 31)
    days = [r[0] for r in jaffle.time_spine_daily(spark, dt.date(2025, 1, 1)).orderBy("date_day").collect()]
    assert (days[0], days[-1]) == (dt.date(2010, 1, 1), dt.date(2025, 1, 30))


def test_holiday_flag(spark, rows):
    days = spark.createDataFrame([(dt.date(2024, 1, 26),), (dt.date(2024, 1, 27),), (None,)], "d date")
    calendar = spark.createDataFrame([(dt.date(2024, 1, 26),)] * 2, "holiday_date date")
    assert rows(K.holiday_flag(days, "d", calendar)) == [
        (None, None), (dt.date(2024, 1, 26), True), (dt.date(2024, 1, 27), False),
    ]
    assert rows(K.holiday_flag(days.filter("d IS NOT NULL"), "d", calendar.limit(0)), "is_holiday") == [(False,), (False,)]
