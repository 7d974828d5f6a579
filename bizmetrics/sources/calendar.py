"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizmetrics.functions.dates import DateLike, as_date


def _with_period_starts(days: DataFrame) -> DataFrame:
    return days.select(
        "date",
        F.trunc("date", "month").alias("first_day_of_month"),
        F.trunc("date", "quarter").alias("first_day_of_quarter"),
    )


def calendar(spark: SparkSession, start: DateLike, end: DateLike) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = F.explode(F.sequence(as_date(start), as_date(end), F.expr("interval 1 day")))
    return _with_period_starts(spark.range(0, 1, 1, 1).select(days.alias("date")))


def calendar_of(df: DataFrame, day: Column) -> DataFrame:
    """One row per day that occurs in ``df``; partial aggregation leaves one row per day and task."""
    return _with_period_starts(df.select(day.cast("date").alias("date")).where("date is not null").distinct())
