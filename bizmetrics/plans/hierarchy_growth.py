"""Customers, ACV and MRR per month at three levels of the product hierarchy, with growth over a year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizmetrics.functions import growth_rate
from bizmetrics.operators.hierarchy import hierarchy_metrics, prior_period
from bizmetrics.sinks.state import PeriodState, content_mark
from bizmetrics.sources.catalog import conform

# Labels of the levels and output names.
LEVELS = {
    "Product Group": "product_group",
    "Product Name": "product_name",
    "Product Category": "product_category",
}
SUMS = {"total_acv": "acv", "total_mrr": "mrr"}
CUSTOMERS = "num_customers"
MEASURES = [CUSTOMERS, *SUMS]
GROWTH = {
    "yoy_growth_customers": CUSTOMERS,
    "yoy_growth_acv": "total_acv",
    "yoy_growth_mrr": "total_mrr",
}
DEFAULT_CATEGORY = "Analytics"


def revenue_base(sources: Mapping[str, DataFrame], category: str = DEFAULT_CATEGORY) -> DataFrame:
    """Revenue rows of one product category, with their place in the hierarchy.

    Inner join: a product missing from the hierarchy has no category and drops out. The
    filter is on the dimension, so the join sees only that category's products. There is no
    broadcast hint, as the product list may grow: Spark broadcasts it below its size
    threshold, and otherwise sorts and merges, where AQE splits a product that holds much of the fact.
    """
    products = sources["hierarchy"].where(F.col("product_category") == category)
    return (
        sources["revenue"]
        .join(products, "product_id")
        .select(
            "month_end_date", "customer_id", "product_category", "product_group", "product_name", "acv", "mrr"
        )
    )


def level_metrics(base: DataFrame, levels: Mapping[str, str] = LEVELS) -> DataFrame:
    """Month × level × object: distinct customers, ACV and MRR."""
    return hierarchy_metrics(base, "month_end_date", levels, "customer_id", SUMS, CUSTOMERS)


def with_prior_year(metrics: DataFrame, by_calendar: bool = False) -> DataFrame:
    """Add the measures of 12 rows (or, with ``by_calendar``, 12 months) earlier."""
    return prior_period(
        metrics,
        ["aggregation_level", "aggregation_object"],
        "month_end_date",
        MEASURES,
        by_calendar=by_calendar,
    )


def growth_report(metrics: DataFrame, by_calendar: bool = False) -> DataFrame:
    """The report from monthly metrics, latest month first."""
    metrics = with_prior_year(metrics, by_calendar)
    growth = [
        growth_rate(F.col(m), F.col(m + "_prior_year"), metrics.schema[m].dataType).alias(name)
        for name, m in GROWTH.items()
    ]
    return metrics.select("*", *growth).orderBy(
        F.col("month_end_date").desc(), "aggregation_level", "aggregation_object"
    )


def hierarchy_growth(
    sources: Mapping[str, DataFrame], category: str = DEFAULT_CATEGORY, by_calendar: bool = False
) -> DataFrame:
    """The report, latest month first."""
    return growth_report(level_metrics(revenue_base(sources, category)), by_calendar)


def metrics_state(
    spark: SparkSession, path: str, revenue: str, hierarchy: DataFrame, category: str = DEFAULT_CATEGORY
) -> PeriodState:
    """Monthly metrics kept at ``path``, from the directory ``revenue``, which is partitioned by ``month_end_date``.

    A month's metrics depend on its own revenue and on the category's products; when a product changes, all months are made anew.
    """
    products = conform(hierarchy, "hierarchy").where(F.col("product_category") == category)

    def compute(rows: DataFrame) -> DataFrame:
        metrics = level_metrics(revenue_base({"revenue": conform(rows, "revenue"), "hierarchy": products}, category))
        return metrics.select(*[c for c in metrics.columns if c != "month_end_date"], "month_end_date")

    return PeriodState(spark, path, revenue, "month_end_date", compute, f"{category}|{content_mark(products)}")


def growth_from_state(state: PeriodState, by_calendar: bool = False) -> DataFrame:
    """The report from kept metrics, after bringing them up to date."""
    state.refresh()
    metrics = state.rows()
    return growth_report(metrics.select("month_end_date", *[c for c in metrics.columns if c != "month_end_date"]), by_calendar)
