"""Run one report as a Spark job.

``spark-submit --py-files bizmetrics.zip bizmetrics/run.py <report> --out <path> [options]``

Tables are read from the catalog under their default names, ``--table name=db.table`` reads another,
``--parquet name=path`` a directory.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from bizmetrics.plans.feature_adoption import feature_adoption
from bizmetrics.plans.hierarchy_growth import DEFAULT_CATEGORY, growth_from_state, hierarchy_growth, metrics_state
from bizmetrics.plans.model_usage import MODEL_PREFIXES, model_usage
from bizmetrics.plans.sales_attainment import DEFAULT_VERTICAL, sales_attainment
from bizmetrics.session import SETTINGS
from bizmetrics.sources import TABLES, Sources

Options = argparse.Namespace
REPORTS: dict[str, Callable[[Mapping[str, DataFrame], Options], DataFrame]] = {
    "hierarchy-growth": lambda s, o: hierarchy_growth(s, o.category, o.by_calendar),
    "model-usage": lambda s, o: model_usage(
        s, Path(o.salt_file).read_text().strip(), o.as_of, o.prefix or MODEL_PREFIXES
    ),
    "feature-adoption": lambda s, o: feature_adoption(s, o.as_of, o.rollup_adoption),
    "sales-attainment": lambda s, o: sales_attainment(s, o.as_of, o.vertical, o.bounded),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bizmetrics.run")
    p.add_argument("report", choices=REPORTS)
    p.add_argument("--out", required=True, help="parquet directory to write; must not exist")
    p.add_argument("--as-of", help="the day the report is run for, YYYY-MM-DD; default today")
    p.add_argument("--table", action="append", default=[], metavar="NAME=TABLE")
    p.add_argument("--parquet", action="append", default=[], metavar="NAME=PATH")
    p.add_argument("--category", default=DEFAULT_CATEGORY)
    p.add_argument("--by-calendar", action="store_true", help="compare with 12 months ago, not 12 rows")
    p.add_argument("--state", help="directory of kept monthly metrics; hierarchy-growth then recomputes changed months only")
    p.add_argument("--salt-file", help="file that holds the salt of the customer keys")
    p.add_argument("--prefix", action="append", help="models whose names begin so; may be repeated")
    p.add_argument("--rollup-adoption", action="store_true", help="adoption counts for the 'All' row too")
    p.add_argument("--vertical", default=DEFAULT_VERTICAL)
    p.add_argument("--bounded", action="store_true", help="end the to-date periods on the report date")
    return p


def sources(spark: SparkSession, options: Options) -> Sources:
    named = dict(pair.split("=", 1) for pair in options.table)
    paths = dict(pair.split("=", 1) for pair in options.parquet)
    unknown = (named.keys() | paths.keys()) - TABLES.keys()
    if unknown:
        raise SystemExit(f"unknown source(s): {', '.join(sorted(unknown))}; known are {', '.join(TABLES)}")
    return Sources({**Sources.warehouse_readers(spark, **named), **Sources.parquet_readers(spark, **paths)})


def incremental_growth(spark: SparkSession, options: Options) -> DataFrame:
    paths = dict(pair.split("=", 1) for pair in options.parquet)
    hierarchy = sources(spark, options)["hierarchy"]
    state = metrics_state(spark, options.state, paths["revenue"], hierarchy, options.category)
    return growth_from_state(state, options.by_calendar)


def main(argv: Sequence[str] | None = None) -> None:
    options = parser().parse_args(argv)
    if options.report == "model-usage" and not options.salt_file:
        raise SystemExit("model-usage needs --salt-file")
    if options.state and (options.report != "hierarchy-growth" or not any(p.startswith("revenue=") for p in options.parquet)):
        raise SystemExit("--state is for hierarchy-growth, with --parquet revenue=<directory partitioned by month_end_date>")
    builder = SparkSession.builder.appName(f"bizmetrics {options.report}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if options.state:
        report = incremental_growth(spark, options)
    else:
        report = REPORTS[options.report](sources(spark, options), options)
    report.write.parquet(options.out)


if __name__ == "__main__":
    main()
