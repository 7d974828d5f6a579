"""Metrics at several levels of a hierarchy, and their value a year earlier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hierarchy_metrics(
    df: DataFrame,
    time: str,
    levels: Mapping[str, str],
    distinct_key: str,
    sums: Mapping[str, str],
    count_name: str,
) -> DataFrame:
    """One row per (time, level, object): exact distinct count of ``distinct_key`` and sums.

    ``levels`` maps a level's label to its column, ``sums`` an output name to its column.
    Distinct counts are not additive, so each level counts its own members; NULL is an
    object of its own at its level.

    One read of ``df`` for all levels. Every row is passed on twice per level, once with its key and once
    with its amounts. Amounts shrink to a row per object before the exchange, so what is
    left to exchange are bare keys. These are spread by (time, level, object, key): a level with a
    single object, or a key that holds much of the input, still uses all reduce tasks.
    The second exchange carries one partial row per (time, level, object) and task.
    """
    types = {field.name: field.dataType for field in df.schema}

    def null(column: str) -> Column:
        return F.lit(None).cast(types[column])

    copies = []
    for label, column in levels.items():
        at = [F.lit(label).alias("aggregation_level"), F.col(column).alias("aggregation_object")]
        keys_only = [F.col(distinct_key).alias("_key"), *[null(c).alias(name) for name, c in sums.items()]]
        sums_only = [null(distinct_key).alias("_key"), *[F.col(c).alias(name) for name, c in sums.items()]]
        copies += [F.struct(*at, *keys_only), F.struct(*at, *sums_only)]
    grain = [time, "aggregation_level", "aggregation_object"]
    totals = [F.sum(name).alias(name) for name in sums]
    per_key = df.select(time, F.inline(F.array(*copies))).groupBy(*grain, "_key").agg(*totals)
    return per_key.groupBy(*grain).agg(F.count("_key").alias(count_name), *totals)


def prior_period(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    measures: Sequence[str],
    periods: int = 12,
    suffix: str = "_prior_year",
    by_calendar: bool = False,
) -> DataFrame:
    """Add each measure's value ``periods`` rows earlier in its series.

    The offset counts rows: a month without data shifts the comparison. With ``by_calendar``
    it counts months, and a month without data compares to NULL; this expects one row per
    month and series. A series holds one row per month, so a window partition stays small.
    """
    in_series = Window.partitionBy(*series)
    if by_calendar:
        month = F.year(time) * 12 + F.month(time)
        earlier = in_series.orderBy(month).rangeBetween(-periods, -periods)
        prior = [F.max(m).over(earlier).alias(m + suffix) for m in measures]
    else:
        prior = [F.lag(m, periods).over(in_series.orderBy(time)).alias(m + suffix) for m in measures]
    return df.select("*", *prior)


def month_spine(df: DataFrame, series: Sequence[str], month_end: str) -> DataFrame:
    """Every month of each series from its first to its last, with the rows of ``df`` where it has any and NULLs where not.

    On these rows an offset of rows is one of months, so that ``prior_period`` gives the same by rows and by calendar. The months are
    made per series from two dates, combined in the tasks; a month that ``df`` has twice stays twice. Month ends must be the last days of months; rows
    without a month are left out.
    """
    ends = df.groupBy(*series).agg(F.min(month_end).alias("_first"), F.max(month_end).alias("_last"))
    starts = F.sequence(F.trunc("_first", "month"), F.trunc("_last", "month"), F.expr("interval 1 month"))
    months = ends.where(F.col("_first").isNotNull()).select(*series, F.explode(starts).alias("_month")).select(*series, F.last_day("_month").alias(month_end))
    renamed = df.select(*[F.col(c).alias(f"_{c}") if c in (*series, month_end) else F.col(c) for c in df.columns])
    same = F.col(month_end) == F.col(f"_{month_end}")
    for column in series:
        same = same & F.col(column).eqNullSafe(F.col(f"_{column}"))
    return months.join(renamed, same, "left").select(*df.columns)
