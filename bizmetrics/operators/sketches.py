"""Percentiles of groups of any size: mergeable sketches of bounded size, to be kept and merged later."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A sketch of this size is exact up to some thousand values, and takes up to 100 KB beyond.
SKETCH_K = 4096
SKETCH = "sketch"


def rank_error(k: int = SKETCH_K) -> float:
    """By how much of a group's size a percentile's rank may be off, with a probability of 99.99 %, whatever the values and the merges.

    A KLL sketch is off by less than 2.296 / k^0.9723 with 99 % (2.6 standard deviations); this is one and a half times that. 0.1 % by default.
    """
    return 1.5 * 2.296 / k**0.9723


def _kind(kind: T.DataType) -> str:
    return "bigint" if isinstance(kind, T.IntegralType) else "double"


def quantile_sketches(df: DataFrame, grain: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """A sketch of ``value`` per ``grain``. Whole numbers stay whole, others are taken as doubles; NULLs don't count.

    Tasks make sketches of their rows, and those are exchanged: a group that holds a third of the rows is a sketch per task.
    """
    kind = _kind(df.schema[value].dataType)
    make = {"bigint": F.kll_sketch_agg_bigint, "double": F.kll_sketch_agg_double}[kind]
    return df.groupBy(*grain).agg(make(F.col(value).cast(kind), k).alias(SKETCH))


def merged_sketches(sketches: DataFrame, grain: Sequence[str], kind: str = "bigint", k: int = SKETCH_K) -> DataFrame:
    """One sketch per coarser ``grain``; the error stays that of one sketch of all values, in whatever order they are merged."""
    merge = {"bigint": F.kll_merge_agg_bigint, "double": F.kll_merge_agg_double}[kind]
    return sketches.groupBy(*grain).agg(merge(SKETCH, k).alias(SKETCH))


def sketch_size(kind: str = "bigint") -> Column:
    """How many values a sketch has seen."""
    return {"bigint": F.kll_sketch_get_n_bigint, "double": F.kll_sketch_get_n_double}[kind](F.col(SKETCH))


def sketch_percentiles(points: Mapping[str, int], kind: str = "bigint") -> list[Column]:
    """Percentiles of a sketch, name → percent, each one of the values seen (nearest rank); NULL where none was seen."""
    at = {"bigint": F.kll_sketch_get_quantile_bigint, "double": F.kll_sketch_get_quantile_double}[kind]
    return [F.when(sketch_size(kind) > 0, at(F.col(SKETCH), F.lit(percent / 100))).alias(name) for name, percent in points.items()]
