"""Results kept per period of a source table, and recomputed only for periods whose files changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "_mark"


def _sum_of_hashes(*columns: Column) -> Column:
    """The same for the same rows in any order; sums of up to 10^18 hashes fit."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).cast("string")


def file_marks(spark: SparkSession, path: str, period: str) -> DataFrame:
    """Per partition of a Parquet directory: its period, and a mark that changes with its files' names, sizes or times.

    Only the listing is read, as for any read of the directory, not the files.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    if period not in files.columns:
        raise ValueError(f"{path} is not partitioned by {period}")
    mark = F.concat_ws(":", F.count("*"), _sum_of_hashes(F.col("path"), F.col("length"), F.col("modificationTime")))
    return files.select(period, "path", "length", "modificationTime").groupBy(period).agg(mark.alias(MARK))


def content_mark(df: DataFrame) -> str:
    """A mark that changes with the rows of ``df``, whatever their order; for dimensions. Reads them all."""
    row = df.agg(F.count("*").alias("n"), _sum_of_hashes(*[F.col(f"`{c}`") for c in df.columns]).alias("hash")).first()
    return f"{row['n']}:{row['hash']}"


class PeriodState:
    """The result of ``compute`` on each period of a Parquet directory, kept in another directory.

    Both are partitioned by ``period``. ``compute`` gets the rows of the changed periods, unread, and returns theirs with the period
    among the columns; a period's result may depend on its own rows only. Each kept period holds, in a row of its own, the
    mark of the files that it was computed from, so data and mark are replaced together, by overwriting the changed
    partitions and no others. ``definition`` stands for all else that the result depends on: another one recomputes everything.

    A run that dies before its commit leaves the state as it was. One that dies during the commit leaves each period old, new or absent, never mixed; the next
    refresh makes what is absent or old. A refresh without changes writes nothing. Periods that left the source become empty. Files that
    change while a refresh reads them are taken by the next, as marks are read first. One refresh at a time; reading beside it is safe
    up to the commit.

    The driver holds the changed periods, of which a table has hundreds or thousands, not their rows. A null period is a period.
    """

    def __init__(
        self, spark: SparkSession, path: str, source: str, period: str, compute: Callable[[DataFrame], DataFrame], definition: str = ""
    ):
        self.spark, self.path, self.source, self.period, self.compute, self.definition = spark, path, source, period, compute, definition

    def _wanted(self) -> DataFrame:
        marks = file_marks(self.spark, self.source, self.period)
        return marks.withColumn(MARK, F.sha2(F.concat_ws("|", F.lit(self.definition), F.col(MARK)), 256))

    def _held(self, like: DataFrame) -> DataFrame:
        schema = f"{MARK} string, `{self.period}` {like.schema[self.period].dataType.simpleString()}"
        try:
            kept = self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = self.spark.createDataFrame([], schema)
        return kept.where(F.col(MARK).isNotNull()).select(self.period, MARK)

    def changes(self) -> DataFrame:
        """The periods that a refresh would make, with the mark of their files; '' for those that left the source."""
        wanted = self._wanted()
        held = self._held(wanted).toDF("held_period", "held")
        both = wanted.join(held, wanted[self.period].eqNullSafe(held["held_period"]), "full")
        gone = F.col(MARK).isNull()
        named = F.when(gone, F.col("held_period")).otherwise(F.col(self.period)).alias(self.period)
        return both.where(~F.coalesce(F.col(MARK), F.lit("")).eqNullSafe(F.col("held"))).select(named, F.coalesce(MARK, F.lit("")).alias(MARK))

    def _among(self, periods: list) -> Column:
        some = F.col(self.period).isin([p for p in periods if p is not None])
        return some | F.col(self.period).isNull() if None in periods else some

    def changed_rows(self, periods: list) -> DataFrame:
        """The source's rows of these periods; their partitions alone are read."""
        return self.spark.read.parquet(self.source).where(self._among(periods))

    def refresh(self) -> list:
        """Bring the state up to date; the periods that were made anew."""
        marks = {r[self.period]: r[MARK] for r in self.changes().collect()}
        if not marks:
            return []
        rows = self.compute(self.changed_rows(list(marks)))
        kind = self.spark.read.parquet(self.source).schema[self.period].dataType
        made = self.spark.createDataFrame(list(marks.items()), f"`{self.period}` {kind.simpleString()}, {MARK} string")
        out = rows.unionByName(made, allowMissingColumns=True)
        # A period goes to one file, or to several where it is large.
        out = out.hint("rebalance", self.period)
        out.write.partitionBy(self.period).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return sorted(marks, key=lambda p: (p is not None, p))

    def rows(self) -> DataFrame:
        """The kept result of all periods."""
        return self.spark.read.parquet(self.path).where(F.col(MARK).isNull()).drop(MARK)
