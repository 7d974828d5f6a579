"""Conditional sums per key, and values of a one-row relation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def period_sums(df: DataFrame, keys: list[str], value: str, periods: Mapping[str, Column]) -> DataFrame:
    """Sum ``value`` per key over the rows of each period, in one pass.

    ``periods`` maps an output name to its condition. Rows outside a period count as 0, so a
    key sums to 0, not NULL, when none of its rows are inside. An empty ``keys`` gives one row.
    """
    sums = [F.sum(F.when(inside, F.col(value)).otherwise(0)).alias(name) for name, inside in periods.items()]
    return df.groupBy(*keys).agg(*sums)


def row_value(one_row: DataFrame) -> Column:
    """A relation of at most one row as a struct, evaluated once; use ``row_value(df)["column"]``.

    A scalar subquery: NULL for no row, an error for more than one.
    """
    return one_row.select(F.struct("*").alias("row")).scalar()


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Every row of ``df`` with the columns of a relation that has exactly one row, such as a global aggregate.

    The row is fetched as a scalar subquery, so there is no join, broadcast or exchange of ``df``.
    """
    row = row_value(one_row)
    return df.select("*", *[row[column].alias(column) for column in one_row.columns])
