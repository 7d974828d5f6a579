"""Sampling-weighted usage volumes: hourly totals, percentiles over hours, and per-bucket summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizmetrics.functions import hour_of_day, scaled as scaled_value

# Sketch size: percentiles are exact up to about this many values, beyond that within 1/10,000 of their rank.
PERCENTILE_ACCURACY = 10_000


def hourly_usage(
    events: DataFrame, keys: Sequence[str], timestamp: Column, sums: Mapping[str, str], averages: Sequence[str]
) -> DataFrame:
    """Reduce an event log to one row per (keys, ``hour_bucket``), the hour of ``timestamp``.

    ``sums`` maps output names to columns. For each column in ``averages`` a sum and a
    non-NULL count are kept, as those can be added up again while averages cannot. The rows
    are combined before the exchange, so the log is shuffled at hour grain at most, and a key
    that holds a third of it is no larger than its number of hours. They are grouped by day and
    hour, two cheap integers per event; the bucket's timestamp is made of them afterwards.
    """
    partials = [F.sum(column).alias(name) for name, column in sums.items()]
    for column in averages:
        partials += [F.sum(column).alias(f"{column}_sum"), F.count(column).alias(f"{column}_count")]
    hours = events.groupBy(*keys, timestamp.cast("date").alias("_day"), F.hour(timestamp).alias("_hour")).agg(*partials)
    bucket = hour_of_day(F.col("_day"), F.col("_hour")).alias("hour_bucket")
    return hours.select(*keys, bucket, *(c for c in hours.columns if c not in {*keys, "_day", "_hour"}))


def merged_average(column: str) -> Column:
    """Average of ``column`` from the partials of ``hourly_usage``; NULL when there was no value."""
    return F.sum(f"{column}_sum").cast("double") / F.nullif(F.sum(f"{column}_count"), F.lit(0))


def approx_percentiles(value: str, points: Mapping[str, int]) -> list[Column]:
    """Percentiles of ``value`` over groups of any size, each one of its values; name → percent.

    One mergeable sketch of bounded size per group, so a large group is never gathered.
    """
    sketch = F.percentile_approx(value, [percent / 100 for percent in points.values()], PERCENTILE_ACCURACY)
    return [sketch[i].alias(name) for i, name in enumerate(points)]


def usage_by_bucket(
    hourly: DataFrame,
    keys: Sequence[str],
    volume: str,
    points: Mapping[str, int],
    peak: str,
    *others: Column,
) -> DataFrame:
    """Add up the hours of each key: percentiles and peak of ``volume`` over hours, and ``others``.

    Hours without events have no row and do not enter the percentiles. A key has as many rows as
    it has different hours, however much it is used: 168 for a week whose events carry times of that week. Nothing
    ties a log's times to its dates, so a log with wrong times may have more, up to the hours of all its
    times. Such groups are small enough to be sorted: percentiles are the values at the nearest rank, exact
    (the 0th is the smallest), and everything else is added up in the same stage, with less to exchange than sketches would take.
    """
    in_bucket = Window.partitionBy(*keys)
    by_volume = in_bucket.orderBy(F.col(volume).asc_nulls_last())
    ranked = hourly.select(
        "*", F.row_number().over(by_volume).alias("_rank"), F.count(volume).over(in_bucket).alias("_hours")
    )

    def value_at(percent: int) -> Column:
        rank = F.expr(f"greatest(1, (_hours * {percent} + 99) div 100)")
        return F.max(F.when(F.col("_rank") == rank, F.col(volume)))

    return ranked.groupBy(*keys).agg(
        *others, *[value_at(percent).alias(name) for name, percent in points.items()], F.max(volume).alias(peak)
    )


def segment_copies(dim: DataFrame, key: str, attributes: Sequence[str], copies: str = "copies") -> DataFrame:
    """How many rows of ``dim`` each key has per combination of attributes.

    Lets rows be multiplied by a count where a join would repeat them. NULL keys match nothing.
    """
    return dim.where(F.col(key).isNotNull()).groupBy(key, *attributes).agg(F.count("*").alias(copies))


def join_segments(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    attributes: Sequence[str],
    scaled: Sequence[str],
) -> DataFrame:
    """Left-join ``dim`` to an aggregate as if it had been joined to the rows before they were summed.

    A key with several distinct attribute combinations yields a row for each; identical
    ``dim`` rows multiply the ``scaled`` columns. ``scaled`` may hold sums and anything that
    scales with them: maxima and percentiles that are themselves values. Decimals keep all their digits.
    """
    matched = df.join(segment_copies(dim, key, attributes), key, "left")
    copies = F.coalesce("copies", F.lit(1))
    columns = [
        scaled_value(F.col(c), copies, df.schema[c].dataType).alias(c) if c in scaled else F.col(c) for c in df.columns
    ]
    return matched.select(*columns, *attributes)
