"""Distinct counts that add up: exact sets of numbered members as bitmaps, united instead of counted anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBER, BUCKET, MEMBERS = "member_number", "member_bucket", "members"


def dense_numbers(keys: DataFrame, key: str, scratch: str, first: int = 1) -> DataFrame:
    """Each different ``key`` with a number of its own from ``first`` on, without gaps; NULL gets none.

    The keys are written to ``scratch``, and a key's number is its place in its file after the sizes of the files before. So
    no task sees all keys: one sorts a row per file. The numbers hold as long as the files do: keep the result, and number new keys from where it ends.
    """
    keys.select(key).where(F.col(key).isNotNull()).distinct().write.parquet(scratch)
    placed = keys.sparkSession.read.parquet(scratch).select(key, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return placed.join(offsets, "_file").select(key, (F.col("_offset") + F.col("_row") + first).alias(NUMBER))


def member_sets(df: DataFrame, grain: Sequence[str], number: str = NUMBER) -> DataFrame:
    """The set of numbers per ``grain``: a bitmap of 4 KB for each bucket of 32,768 numbers that occurs. NULL is no member.

    Rows are combined in the tasks, so what is exchanged is a bitmap per task, grain and bucket, however many rows a member or a group
    has. Bitmaps pay where a bucket of a group has some hundred members or more; for groups of few members count the keys
    themselves (``hierarchy_metrics``).
    """
    position, bucket = F.bitmap_bit_position(F.col(number)), F.bitmap_bucket_number(F.col(number)).alias(BUCKET)
    return df.where(F.col(number).isNotNull()).groupBy(*grain, bucket).agg(F.bitmap_construct_agg(position).alias(MEMBERS))


def united(sets: DataFrame, grain: Sequence[str | Column]) -> DataFrame:
    """The sets per coarser ``grain``: unions, so that a member in several of the finer ones is one."""
    return sets.groupBy(*grain, BUCKET).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS))


def set_sizes(sets: DataFrame, grain: Sequence[str], name: str) -> DataFrame:
    """The number of different members per ``grain``. A hot grain is spread over its buckets."""
    return united(sets, grain).groupBy(*grain).agg(F.sum(F.bitmap_count(F.col(MEMBERS))).alias(name))


def levels_of(sets: DataFrame, keep: Sequence[str], levels: dict[str, str]) -> DataFrame:
    """Each set once per level: label → column, as ``aggregation_level`` and ``aggregation_object``."""
    objects = [F.struct(F.lit(label).alias("aggregation_level"), F.col(column).alias("aggregation_object")) for label, column in levels.items()]
    return sets.select(*keep, BUCKET, MEMBERS, F.inline(F.array(*objects)))


def trailing_months(sets: DataFrame, month_end: str, months: int, last: Column) -> DataFrame:
    """Each set in its month and the ``months`` - 1 after it, up to ``last``: united, those of a month are its trailing window."""
    after = F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("_after")
    moved = sets.select("*", after).withColumn(month_end, F.last_day(F.add_months(month_end, F.col("_after"))))
    return moved.where(F.col(month_end) <= last).drop("_after")
