"""Kept results: what a refresh reads and replaces, what a killed one leaves."""

import datetime
import os
from pathlib import Path

import pytest
from builders import day, money, table
from pyspark.sql import functions as F

from bizmetrics import run
from bizmetrics.plans import hierarchy_growth as growth
from bizmetrics.queries import decimals_as_doubles
from bizmetrics.sinks import PeriodState, content_mark, file_marks, scratch_folder

PRODUCTS = [(1, "Analytics", "G1", "N1"), (2, "Analytics", "G1", "N2"), (3, "Analytics", None, "N3"), (4, "Storage", "G9", "N9")]
MONTHS = [f"{y}-{m:02d}-28" for y in (2023, 2024) for m in range(1, 13)]


def revenue(spark, months=MONTHS, seed=0):
    rows = [(day(m), (i * 7 + k + seed) % 5, k % 4 + 1, money(i + k + seed), money(k)) for i, m in enumerate(months) for k in range(6)]
    return table(spark, "revenue", rows)


def write(df, path, mode="append"):
    df.coalesce(1).write.partitionBy("month_end_date").mode(mode).option("partitionOverwriteMode", "dynamic").parquet(str(path))


def files_of(path):
    return {str(f): (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path).rglob("*.parquet")}


def sorted_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def kept(spark, tmp_path):
    write(revenue(spark), tmp_path / "revenue")
    hierarchy = table(spark, "hierarchy", PRODUCTS)

    def state(category="Analytics", products=hierarchy):
        return growth.metrics_state(spark, str(tmp_path / "state"), str(tmp_path / "revenue"), products, category)

    def full():
        return growth.hierarchy_growth({"revenue": spark.read.parquet(str(tmp_path / "revenue")), "hierarchy": hierarchy}, "Analytics")

    return state, full, tmp_path


def test_a_first_run_makes_all_and_a_second_nothing(kept):
    state, full, tmp_path = kept
    assert [str(m) for m in state().refresh()] == MONTHS
    before = files_of(tmp_path / "state")
    assert state().refresh() == [] and files_of(tmp_path / "state") == before
    assert sorted_rows(growth.growth_from_state(state())) == sorted_rows(full())


def test_one_changed_month_is_all_that_is_read_and_replaced(spark, kept):
    state, full, tmp_path = kept
    state().refresh()
    before = files_of(tmp_path / "state")
    write(revenue(spark, ["2024-03-28"], seed=3), tmp_path / "revenue")
    s = state()
    changed = [r["month_end_date"] for r in s.changes().collect()]
    assert changed == [datetime.date(2024, 3, 28)]
    # The plan of what is recomputed: one partition of the fact, before any filter on rows.
    rows = s.compute(s.changed_rows(changed))
    (scan,) = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    filters = scan.split("PartitionFilters: ")[1].split("], ")[0]
    assert "2024-03-28" in filters and "isnotnull(month_end_date" in filters and "month_end_date" not in scan.split("ReadSchema: ")[1]
    read = s.changed_rows(changed).select("_metadata.file_path").distinct().collect()
    assert {Path(r["file_path"]).parent.name for r in read} == {"month_end_date=2024-03-28"}
    assert s.refresh() == changed
    after = files_of(tmp_path / "state")
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if "2024-03-28" in f}
    assert sorted_rows(growth.growth_from_state(state())) == sorted_rows(full())


def test_new_replaced_and_lost_months(spark, kept):
    state, full, tmp_path = kept
    state().refresh()
    write(revenue(spark, ["2025-01-28"]), tmp_path / "revenue")
    write(revenue(spark, ["2023-05-28"], seed=2), tmp_path / "revenue", "overwrite")
    for f in (tmp_path / "revenue" / "month_end_date=2023-02-28").iterdir():
        f.unlink()
    assert [str(m) for m in state().refresh()] == ["2023-02-28", "2023-05-28", "2025-01-28"]
    assert sorted_rows(growth.growth_from_state(state())) == sorted_rows(full())
    assert not state().refresh()


def test_a_month_without_rows_of_the_category_replaces_the_old_ones(spark, kept):
    state, full, tmp_path = kept
    state().refresh()
    write(table(spark, "revenue", [(day("2023-05-28"), 1, 4, money(1), money(1))]), tmp_path / "revenue", "overwrite")
    assert len(state().refresh()) == 1
    assert "2023-05-28" not in {str(r["month_end_date"]) for r in state().rows().collect()}
    assert sorted_rows(growth.growth_from_state(state())) == sorted_rows(full())


def test_another_definition_makes_all_anew(spark, kept):
    state, _, _ = kept
    state().refresh()
    assert len(state("Storage").refresh()) == len(MONTHS)
    assert {r["aggregation_object"] for r in state("Storage").rows().collect()} == {"Storage", "G9", "N9"}
    moved = table(spark, "hierarchy", [(1, "Storage", "G1", "N1"), *PRODUCTS[1:]])
    assert len(state("Storage", moved).refresh()) == len(MONTHS)
    # Products of other categories don't matter.
    other = table(spark, "hierarchy", [(1, "Storage", "G1", "N1"), (2, "Analytics", "G7", "N2"), *PRODUCTS[2:]])
    assert state("Storage", other).refresh() == []


def test_a_killed_run_leaves_the_old_state(spark, kept):
    state, full, tmp_path = kept
    state().refresh()
    before, rows = files_of(tmp_path / "state"), sorted_rows(state().rows())
    write(revenue(spark, ["2024-03-28", "2024-04-28"], seed=3), tmp_path / "revenue")
    s = state()
    whole = s.compute
    # Dies while it writes: the rows of one month fail after others are done.
    s.compute = lambda df: whole(df).withColumn("num_customers", F.when(F.col("month_end_date") == "2024-04-28", F.raise_error(F.lit("killed"))).otherwise(F.col("num_customers")).cast("bigint"))
    with pytest.raises(Exception, match="killed"):
        s.refresh()
    assert files_of(tmp_path / "state") == before and sorted_rows(state().rows()) == rows
    assert len(state().refresh()) == 2
    assert sorted_rows(growth.growth_from_state(state())) == sorted_rows(full())


def test_a_run_killed_in_its_commit_is_mended_by_the_next(kept):
    """Between the removal of an old partition and the arrival of the new one a month is absent."""
    state, full, tmp_path = kept
    state().refresh()
    for f in (tmp_path / "state" / "month_end_date=2023-07-28").iterdir():
        f.unlink()
    assert [str(m) for m in state().refresh()] == ["2023-07-28"]
    assert sorted_rows(growth.growth_from_state(state())) == sorted_rows(full())


def test_a_null_period_is_a_period(spark, tmp_path):
    def compute(df):
        return df.groupBy("p").agg(F.count("*").alias("n"))

    def put(rows):
        spark.createDataFrame(rows, "p int, v int").coalesce(1).write.partitionBy("p").mode("append").parquet(str(tmp_path / "in"))

    state = PeriodState(spark, str(tmp_path / "out"), str(tmp_path / "in"), "p", compute)
    put([(None, 1), (None, 2), (3, 1)])
    assert state.refresh() == [None, 3]
    put([(None, 7)])
    assert state.refresh() == [None]
    assert {(r["p"], r["n"]) for r in state.rows().collect()} == {(None, 3), (3, 1)}


def test_marks(spark, tmp_path):
    write(revenue(spark), tmp_path / "revenue")
    with pytest.raises(ValueError, match="not partitioned by day"):
        file_marks(spark, str(tmp_path / "revenue"), "day")
    marks = dict(map(tuple, file_marks(spark, str(tmp_path / "revenue"), "month_end_date").collect()))
    one = next((tmp_path / "revenue" / "month_end_date=2024-01-28").glob("*.parquet"))
    os.utime(one, (1, 1))
    again = dict(map(tuple, file_marks(spark, str(tmp_path / "revenue"), "month_end_date").collect()))
    assert {str(m) for m in marks if marks[m] != again[m]} == {"2024-01-28"}
    rows = table(spark, "hierarchy", PRODUCTS)
    assert content_mark(rows) == content_mark(rows.orderBy(F.desc("product_id"))) != content_mark(rows.limit(3))
    assert content_mark(rows.limit(0)).startswith("0:")


def test_the_job_keeps_state(spark, tmp_path):
    write(revenue(spark), tmp_path / "revenue")
    table(spark, "hierarchy", PRODUCTS).write.parquet(str(tmp_path / "hierarchy"))
    inputs = [f"--parquet={n}={tmp_path / n}" for n in ("revenue", "hierarchy")]
    for out, more in (("full", []), ("first", [f"--state={tmp_path / 'state'}"]), ("second", [f"--state={tmp_path / 'state'}"])):
        run.main(["hierarchy-growth", "--out", str(tmp_path / out), *inputs, *more])
    full, first, second = (sorted_rows(decimals_as_doubles(spark.read.parquet(str(tmp_path / out)))) for out in ("full", "first", "second"))
    assert full == first == second
    with pytest.raises(SystemExit, match="--state"):
        run.main(["hierarchy-growth", "--out", "x", "--state", "y"])


def test_scratch_folders_are_new_and_shared(spark):
    assert scratch_folder(spark) != scratch_folder(spark)

    class Cluster:
        conf = {}

        class sparkContext:
            master = "local-cluster[3,2,1024]"

    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch_folder(Cluster)
