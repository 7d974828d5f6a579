"""Reporting periods as DataFrames over the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizmetrics.functions.dates import (
    DateLike,
    as_date,
    month_week_end,
    month_week_start,
    months_before,
    years_before,
)


def report_date(as_of: DateLike = None) -> Column:
    """The last settled day: the day before ``as_of``."""
    return F.date_sub(as_date(as_of), 1)


def previous_month_days(calendar: DataFrame, as_of: DateLike = None) -> DataFrame:
    """Calendar days of the month before ``as_of``.

    The bounds are constant, and an equi-join on ``date`` carries them over to the other
    side's scan, where they prune date partitions.
    """
    month_ago = months_before(as_date(as_of), 1)
    return calendar.where(F.col("date").between(F.trunc(month_ago, "month"), F.last_day(month_ago)))


def bucket_days(days: DataFrame) -> DataFrame:
    """Each day with the first day of its 7-day bucket of the month."""
    return days.select(
        "date", month_week_start(F.col("date"), F.col("first_day_of_month")).alias("first_day_of_week")
    )


def with_bucket_end(df: DataFrame, start: str, end: str) -> DataFrame:
    """Add the bucket's last day; it follows from the first, so it need not be a grouping key."""
    return df.withColumn(end, month_week_end(F.col(start)))


def period_row(calendar: DataFrame, as_of: DateLike = None) -> DataFrame:
    """The calendar row of the report date with the bounds of its year, quarter, month and prior year.

    No row when the calendar lacks that day.
    """
    day = F.col("date")
    first_of_prior_year = F.trunc(years_before(day, 1), "year")
    return calendar.where(day == report_date(as_of)).select(
        day.alias("as_of_date"),
        F.col("first_day_of_month").alias("first_day_of_current_month"),
        F.col("first_day_of_quarter").alias("first_day_of_current_quarter"),
        F.trunc(day, "year").alias("first_day_of_current_year"),
        first_of_prior_year.alias("first_day_of_prior_year"),
        F.date_sub(F.add_months(first_of_prior_year, 12), 1).alias("last_day_of_prior_year"),
        F.quarter(day).alias("current_quarter_number"),
    )
