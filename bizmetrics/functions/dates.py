"""Date expressions. All of them fold to literals when given a literal, so they reach scan filters."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from bizmetrics.functions.arithmetic import least_strict

DateLike = datetime.date | str | Column | None


def as_date(value: DateLike) -> Column:
    """A DATE column from a date, an ISO string or a column; ``None`` means today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, str):
        value = datetime.date.fromisoformat(value)
    return F.lit(value).cast("date")


def months_before(day: Column, n: int) -> Column:
    return F.add_months(day, -n)


def years_before(day: Column, n: int) -> Column:
    return F.add_months(day, -12 * n)


def month_week_start(day: Column, first_of_month: Column) -> Column:
    """First day of the 7-day bucket ``day`` falls in, buckets counted from the 1st of the month.

    These are not calendar weeks: they start on days 1, 8, 15, 22 and 29.
    """
    bucket = F.floor(F.datediff(day, first_of_month) / 7).cast("int")
    return F.date_add(first_of_month, bucket * 7)


def month_week_end(start: Column) -> Column:
    """Last day of the bucket that begins on ``start``, clipped to the end of the month."""
    return least_strict(F.date_add(start, 6), F.last_day(start))


def hour_bucket(timestamp: Column) -> Column:
    """Zone-less timestamp cut to the hour, whatever the session time zone.

    ``date_trunc`` would pass through a zoned timestamp and move hours that the
    session zone skips.
    """
    return hour_of_day(timestamp.cast("date"), F.hour(timestamp))


def hour_of_day(day: Column, hour: Column) -> Column:
    """The zone-less timestamp at which an hour of a day begins."""
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, F.lit(0), F.lit(0))


def month_label(day: Column) -> Column:
    """Lower-case month name and year, such as ``january_2024``."""
    return F.lower(F.date_format(day, "MMMM_yyyy"))
