"""Membership flags, and distinct counts of entities per flag and label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def member_counts(members: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per key that is in any of the relations, with its number of rows in each.

    ``members`` maps a name to a relation that has ``key``. All relations are read in one
    union and reduced in one exchange, in place of one distinct and one join each. A key
    with very many rows leaves each task as one.

    The bucket follows from the key, so it does not change the groups. It only keeps a join on
    the key from building on this exchange: AQE splits a key that the other side repeats very often
    only where both sides come straight from an exchange of their own.
    """
    tagged = [df.select(F.col(key), F.lit(name).alias("_member")) for name, df in members.items()]
    return (
        reduce(DataFrame.unionAll, tagged)
        .where(F.col(key).isNotNull())
        .groupBy(F.pmod(F.xxhash64(key), F.lit(1024)).alias("_bucket"), key)
        .agg(*[F.count_if(F.col("_member") == name).alias(name) for name in members])
        .drop("_bucket")
    )


def join_member_counts(df: DataFrame, members: Mapping[str, DataFrame], key: str) -> DataFrame:
    """``df`` with the number of rows its key has in each relation. Rows are neither lost nor repeated."""
    counted = df.join(member_counts(members, key), key, "left")
    return counted.select(*df.columns, *[F.coalesce(name, F.lit(0)).alias(name) for name in members])


def membership_flags(df: DataFrame, members: Mapping[str, DataFrame], key: str) -> DataFrame:
    """``df`` with a boolean per relation: whether the row's key occurs there."""
    return join_member_counts(df, members, key).withColumns({name: F.col(name) > 0 for name in members})


def repeat_rows(df: DataFrame, times: Column, chunk: int = 10_000, partitions: int | None = None) -> DataFrame:
    """Each row ``times`` times.

    Rows of up to ``chunk`` repetitions are repeated where they are. Others are first cut into chunks, and these dealt out
    evenly, so a row repeated billions of times is not written by one task. The number of partitions they are dealt to
    is explicit, as AQE would judge chunks by their own size and merge them: ``partitions``, or the number that AQE starts from.
    """
    if partitions is None:
        conf = df.sparkSession.conf
        default = conf.get("spark.sql.shuffle.partitions")
        partitions = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or default)
    numbered = F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / chunk)))
    in_chunk = F.least(F.lit(chunk), F.col("_times") - F.col("_chunk") * chunk)
    counted = df.withColumn("_times", times.cast("bigint"))
    few = counted.where((F.col("_times") > 0) & (F.col("_times") <= chunk)).withColumn("_part", F.col("_times"))
    many = (
        counted.where(F.col("_times") > chunk)
        .withColumn("_chunk", numbered)
        .repartition(partitions)
        .withColumn("_part", in_chunk.cast("bigint"))
        .drop("_chunk")
    )
    repeated = few.unionByName(many).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_part"))))
    return repeated.select(*df.columns)


def count_name(prefix: str, entity: str) -> str:
    return f"{prefix}_{entity}"


def rollup_distinct(
    df: DataFrame,
    label: str,
    entities: Mapping[str, str],
    flags: Mapping[str, str],
    with_total: bool = True,
    total_prefix: str = "total",
) -> DataFrame:
    """Distinct entities per label and over all labels, in total and among the rows of each flag.

    ``entities`` maps an entity's name to its id column, ``flags`` a name to a boolean column.
    Returns ``label``, ``is_total`` (1 on the row over all labels), and the counts
    ``total_<entity>`` and ``<flag name>_<entity>``. Without ``with_total`` there is no row over all labels;
    with it there always is one, with zeros if there are no rows at all.

    Exact, in one pass. The first exchange is keyed on (label, id), so neither a label nor the
    total is ever gathered in one task, and an id that occurs in many rows is combined
    beforehand. The second carries one partial row per label and task.
    """
    ids = list(entities.values())
    sets = [[label, i] for i in ids]
    if with_total:
        sets += [[i] for i in ids]
    per_id = df.groupingSets(sets, label, *ids).agg(
        F.grouping(label).alias("is_total"),
        *[
            F.when(F.grouping(i) == 0, F.col(i).isNotNull()).otherwise(False).alias(f"_is_{name}")
            for name, i in entities.items()
        ],
        *[F.coalesce(F.bool_or(column), F.lit(False)).alias(f"_any_{name}") for name, column in flags.items()],
    )
    if with_total:  # a row that counts as nothing keeps the total in the result when there are no rows
        nothing = {"is_total": F.lit(1)} | {c: F.lit(False) for c in per_id.columns if c.startswith(("_is_", "_any_"))}
        empty = df.sparkSession.range(1).select(
            *[nothing.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in per_id.schema]
        )
        per_id = per_id.unionAll(empty)
    counts: list[Column] = [
        F.count_if(F.col(f"_is_{entity}")).alias(count_name(total_prefix, entity)) for entity in entities
    ]
    for flag in flags:
        counts += [
            F.count_if(F.col(f"_is_{entity}") & F.col(f"_any_{flag}")).alias(count_name(flag, entity))
            for entity in entities
        ]
    return per_id.groupBy(label, "is_total").agg(*counts)


def metric_rows(flags: Mapping[str, str], entities: Mapping[str, str], metric: str = "metric_name") -> Column:
    """The flag counts of ``rollup_distinct`` as an array with a struct per flag that has any entity.

    ``flags`` maps a flag name to its label, ``entities`` an entity to the output name of its count.
    """
    rows = [
        F.struct(
            F.lit(text).alias(metric),
            *[F.col(count_name(flag, entity)).alias(name) for entity, name in entities.items()],
        )
        for flag, text in flags.items()
    ]
    return F.filter(F.array(*rows), lambda row: F.greatest(*[row[name] for name in entities.values()]) > 0)


def flags_to_long(
    counts: DataFrame, keys: Sequence[str], flags: Mapping[str, str], entities: Mapping[str, str]
) -> DataFrame:
    """One row per key and flag in place of a column per flag."""
    return counts.select(*keys, F.inline(metric_rows(flags, entities)))
