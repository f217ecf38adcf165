"""Day calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martmill.functions.columns import ColumnLike, as_column, date_shift


def _days(bounds: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name))


def date_spine(
    spark: SparkSession, start: dt.date, end_exclusive: dt.date, name: str = "date_day"
) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end_exclusive``."""
    last = end_exclusive - dt.timedelta(days=1)
    if last < start:
        return spark.createDataFrame([], f"{name} date")
    return _days(spark.range(1), F.lit(start), F.lit(last), name)


def spine_over(df: DataFrame, c: ColumnLike, name: str = "date_day") -> DataFrame:
    """One row per day between the first and last value of a column.

    The bounds are a one-row aggregate inside the same plan; the number of rows
    is the number of calendar days, however large ``df`` is.
    """
    day = as_column(c).cast("date")
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter(F.col("lo").isNotNull())
    return _days(bounds, F.col("lo"), F.col("hi"), name)


def time_spine_window(
    spine: DataFrame,
    as_of: dt.date | Column,
    years_back: int = 20,
    days_ahead: int = 30,
    name: str = "date_day",
) -> DataFrame:
    """Spine days strictly between ``as_of`` less some years and ``as_of`` plus some days."""
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return spine.filter(
        (F.col(name) > date_shift(today, "year", -years_back))
        & (F.col(name) < date_shift(today, "day", days_ahead))
    )


def holiday_flag(
    df: DataFrame, day: str, calendar: DataFrame, calendar_day: str = "holiday_date", name: str = "is_holiday"
) -> DataFrame:
    """Mark days listed in ``calendar``; a NULL day has a NULL flag.

    The calendar is broadcast: after the distinct it cannot hold more than the days there are. So
    the rows of a very frequent day are never gathered by day.
    """
    listed = calendar.select(F.col(calendar_day).cast("date").alias("_holiday")).distinct()
    joined = df.join(F.broadcast(listed), F.col(day) == F.col("_holiday"), "left")
    flag = F.when(F.col(day).isNotNull(), F.col("_holiday").isNotNull())
    return joined.withColumn(name, flag).drop("_holiday")
