import pytest
from builders import day, money, table

from bizmetrics import run


def test_a_report_is_written_as_parquet(spark, tmp_path):
    table(spark, "revenue", [(day("2024-01-31"), 1, 1, money(5), money(1))]).write.parquet(str(tmp_path / "revenue"))
    table(spark, "hierarchy", [(1, "Storage", "G", "N")]).write.parquet(str(tmp_path / "hierarchy"))
    inputs = [f"--parquet={n}={tmp_path / n}" for n in ("revenue", "hierarchy")]
    run.main(["hierarchy-growth", "--out", str(tmp_path / "out"), "--category", "Storage", *inputs])
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r["aggregation_level"], r["aggregation_object"]) for r in rows} == {
        ("Product Category", "Storage"),
        ("Product Group", "G"),
        ("Product Name", "N"),
    }


def test_every_report_runs_for_a_given_day(spark, tmp_path, small_dir):
    from bizmetrics.sources.testdata import TestTables

    for name, df in TestTables(spark, small_dir).sources().items():
        df.write.parquet(str(tmp_path / name))
    (tmp_path / "salt").write_text("pepper\n")
    inputs = [f"--parquet={n}={tmp_path / n}" for n in run.TABLES]
    options = {
        "hierarchy-growth": ["--category", "PROMO", "--by-calendar"],
        "model-usage": ["--as-of", "2024-02-15", "--salt-file", str(tmp_path / "salt")],
        "feature-adoption": ["--as-of", "2024-01-31", "--rollup-adoption"],
        "sales-attainment": ["--as-of", "2001-05-15", "--vertical", "BUILDING", "--bounded"],
    }
    for report in run.REPORTS:
        out = str(tmp_path / f"out_{report}")
        run.main([report, "--out", out, *options[report], *inputs])
        assert spark.read.parquet(out).count() > 0


def test_a_report_runs_for_today_by_default(spark, tmp_path, small_dir):
    from bizmetrics.sources.testdata import TestTables

    sources = TestTables(spark, small_dir).sources()
    options = ["sales-attainment", "--out", "x", "--vertical", "BUILDING"]
    rows = run.REPORTS["sales-attainment"](sources, run.parser().parse_args(options)).collect()
    yesterday = spark.sql("SELECT current_date() - 1 AS day").first()["day"]
    assert rows and {r["report_date"] for r in rows} == {yesterday}


def test_prefixes_are_an_option(spark, small_dir, tmp_path):
    from bizmetrics.sources.testdata import TestTables

    (tmp_path / "salt").write_text("pepper")
    sources = TestTables(spark, small_dir).sources()
    options = ["model-usage", "--out", "x", "--as-of", "2024-02-15", "--salt-file", str(tmp_path / "salt")]

    def models(*more):
        rows = run.REPORTS["model-usage"](sources, run.parser().parse_args([*options, *more])).collect()
        return {r["model"] for r in rows}

    assert models("--prefix", "partner-b/") == {"partner-b/other-1"}
    assert models("--prefix", "partner-b/", "--prefix", "partner-a/model-family-y") == {"partner-b/other-1", "partner-a/model-family-y-1"}
    assert models() == {"partner-a/model-family-x-1", "partner-a/model-family-x-2", "partner-a/model-family-y-1"}


def test_bad_options_are_refused(spark, tmp_path):
    with pytest.raises(SystemExit, match="unknown source"):
        run.main(["hierarchy-growth", "--out", "x", "--table", "revenu=db.t"])
    with pytest.raises(SystemExit, match="salt"):
        run.main(["model-usage", "--out", "x"])
