"""Sets of dense numbers: counts of unions equal counts of the members themselves."""

import random
from collections import defaultdict

import pytest
from builders import day
from pyspark.sql import functions as F

from bizmetrics.operators import dense_numbers, levels_of, member_sets, set_sizes, trailing_months, united


def test_numbers_have_no_gaps_whatever_the_files(spark, tmp_path):
    keys = spark.range(5_000).select(F.concat(F.lit("k"), F.col("id") % 3_000).alias("key")).union(spark.sql("SELECT CAST(NULL AS STRING)")).repartition(7, F.rand(1))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "700")
    try:
        numbers = dense_numbers(keys, "key", str(tmp_path / "keys"), first=11)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    rows = [tuple(r) for r in numbers.collect()]
    assert sorted(n for _, n in rows) == list(range(11, 3_011)) and len({k for k, _ in rows}) == 3_000
    assert sorted(rows) == sorted(tuple(r) for r in numbers.collect())
    assert len(list((tmp_path / "keys").glob("*.parquet"))) > 1
    assert dense_numbers(keys.limit(0), "key", str(tmp_path / "none")).collect() == []


@pytest.fixture(scope="module")
def members(spark):
    """(month, group, category, number): a hot group with many numbers over several buckets, few in others, NULLs and repeated rows."""
    rng, rows = random.Random(4), []
    for i in range(6_000):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        number = rng.choice([None, 1, 32_768, 32_769, rng.randrange(1, 200_000), rng.randrange(1, 50)])
        month = rng.choice(["2024-01-31", "2024-02-29", "2024-03-31", "2024-12-31"])
        rows += [(day(month), group, "c1" if group in ("a", "hot") else "c2", number)] * rng.choice([1, 1, 3])
    return rows, spark.createDataFrame(rows, "month date, grp string, cat string, number bigint").repartition(5)


def test_counts_equal_the_members(members):
    rows, df = members
    sets = member_sets(df, ["month", "grp", "cat"], "number")
    for columns in (["month", "grp"], ["cat"], ["month"], ["grp", "cat"]):
        wanted = defaultdict(set)
        for row in rows:
            named = dict(zip(("month", "grp", "cat"), row, strict=False))
            if row[3] is not None:
                wanted[tuple(named[c] for c in columns)].add(row[3])
        found = {tuple(r[c] for c in columns): r["n"] for r in set_sizes(sets, columns, "n").collect()}
        assert found == {key: len(members) for key, members in wanted.items()}


def test_unions_may_be_made_in_steps(members):
    _, df = members
    sets = member_sets(df, ["month", "grp", "cat"], "number")
    steps = united(united(sets, ["month", "cat"]), ["cat"])
    assert sorted(set_sizes(steps, ["cat"], "n").collect()) == sorted(set_sizes(sets, ["cat"], "n").collect())


def test_levels_and_trailing_windows(members):
    rows, df = members
    sets = member_sets(df, ["month", "grp", "cat"], "number")
    moved = trailing_months(sets, "month", 3, F.lit("2024-12-31").cast("date"))
    found = {tuple(r)[:3]: r["n"] for r in set_sizes(levels_of(moved, ["month"], {"G": "grp", "C": "cat"}), ["month", "aggregation_level", "aggregation_object"], "n").collect()}
    wanted = defaultdict(set)
    ends = [day(m) for m in ("2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30", "2024-05-31", "2024-12-31")]
    for month, group, category, number in rows:
        for end in ends:
            if number is not None and 0 <= end.month - month.month <= 2:
                wanted[end, "G", group].add(number)
                wanted[end, "C", category].add(number)
    assert found == {key: len(members) for key, members in wanted.items()}


def test_a_task_combines_before_the_exchange(members):
    """A row per different bucket of a group leaves a task, not a row per member."""
    _, df = members
    plan = set_sizes(member_sets(df, ["grp"], "number"), ["grp"], "n")._jdf.queryExecution().executedPlan().toString()
    exchanges = [below for line, below in zip(plan.splitlines(), plan.splitlines()[1:], strict=False) if "Exchange hash" in line]
    assert len(exchanges) >= 2 and all("partial_" in line for line in exchanges)
