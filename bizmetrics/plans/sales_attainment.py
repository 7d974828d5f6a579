"""Sales of a vertical's account tiers against targets: prior year, and year, quarter and month to date."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizmetrics.functions import as_date, safe_divide, scaled
from bizmetrics.functions.dates import DateLike
from bizmetrics.operators.periods import period_row
from bizmetrics.operators.sums import attach_row, period_sums, row_value

# Vertical, tiers, opportunity types, won stage, and output names.
DEFAULT_VERTICAL = "Financial Services"
VERTICAL_TIER = "Tier 2"
STRATEGIC_TIER = "Tier 1"
OPPORTUNITY_TYPES = ("New Business", "Upsell", "Cross-sell", "Renewal")
WON = "Closed Won"
CREATED, CLOSED = "pipeline_creation_date", "close_date"
YEAR, QUARTER, MONTH = (f"first_day_of_current_{period}" for period in ("year", "quarter", "month"))
PRIOR_YEAR = "first_day_of_prior_year"
PRIOR_YEAR_END = "last_day_of_prior_year"
# Each sum: the date that counts, the period's first day, its last day if it has one, whether only won deals count.
ACTUALS = {
    "prior_year_pipeline_acv": (CREATED, PRIOR_YEAR, PRIOR_YEAR_END, False),
    "prior_year_closed_won_acv": (CLOSED, PRIOR_YEAR, PRIOR_YEAR_END, True),
    "ytd_pipeline_acv": (CREATED, YEAR, None, False),
    "ytd_closed_won_acv": (CLOSED, YEAR, None, True),
    "qtd_pipeline_acv": (CREATED, QUARTER, None, False),
    "qtd_closed_won_acv": (CLOSED, QUARTER, None, True),
    "mtd_pipeline_acv": (CREATED, MONTH, None, False),
    "mtd_closed_won_acv": (CLOSED, MONTH, None, True),
}
ATTAINMENT = {
    "ytd_percent_to_annual_target": ("total_ytd_closed_won_acv", "total_annual_target_acv"),
    "qtd_percent_to_quarter_target": ("total_qtd_closed_won_acv", "current_quarter_target_acv"),
    "mtd_percent_to_month_target": ("total_mtd_closed_won_acv", "current_month_target_acv"),
}


def account_cohort(
    sources: Mapping[str, DataFrame], as_of: DateLike = None, vertical: str = DEFAULT_VERTICAL
) -> DataFrame:
    """Accounts with their tier: the vertical's, distinct by id and name, and this year's strategic list as it is.

    An account may be in both tiers, and counts in each.
    """
    of_vertical = (
        sources["customers"]
        .where((F.col("industry_vertical") == vertical) & F.col("crm_account_id").isNotNull())
        .select("crm_account_id", "account_name")
        .distinct()
    )
    strategic = sources["strategic"].where(F.col("fiscal_year") == F.year(as_date(as_of)))
    return of_vertical.withColumn("priority_level", F.lit(VERTICAL_TIER)).union(
        strategic.select("crm_account_id", "account_name", F.lit(STRATEGIC_TIER).alias("priority_level"))
    )


def period_conditions(refs: Column, bounded: bool = False) -> dict[str, Column]:
    """What counts towards each of ``ACTUALS``; pipeline by creation date, won deals by close date.

    The to-date periods have no upper end, so rows dated after the report date count too,
    unless ``bounded``.
    """
    conditions = {}
    for name, (date, first, last, won) in ACTUALS.items():
        inside = F.col(date) >= refs[first]
        if last or bounded:
            inside = inside & (F.col(date) <= refs[last or "as_of_date"])
        conditions[name] = inside & (F.col("stage_name") == WON) if won else inside
    return conditions


def opportunity_actuals(opportunities: DataFrame, refs: DataFrame, bounded: bool = False) -> DataFrame:
    """Pipeline and won value per account and period.

    Opportunities outside every period stay in, as they make an account's sums 0 in place of NULL.
    """
    relevant = opportunities.where(F.col("opportunity_type").isin(*OPPORTUNITY_TYPES))
    conditions = period_conditions(row_value(refs), bounded)
    return period_sums(relevant, ["crm_account_id"], "annual_contract_value", conditions)


def vertical_targets(
    targets: DataFrame, refs: DataFrame, as_of: DateLike = None, vertical: str = DEFAULT_VERTICAL
) -> DataFrame:
    """One row: the vertical's targets for the year of ``as_of``, and its current quarter and month.

    Quarter and month are the report date's, one day before ``as_of``, so on January 1st they
    are of another year than the targets.
    """
    month = F.col("target_month")
    row = row_value(refs)
    this_year = targets.where((F.col("target_vertical") == vertical) & (F.year(month) == F.year(as_date(as_of))))
    return period_sums(
        this_year,
        [],
        "target_acv",
        {
            "total_annual_target_acv": F.lit(True),
            "current_quarter_target_acv": F.quarter(month) == row["current_quarter_number"],
            "current_month_target_acv": F.trunc(month, "month") == row["first_day_of_current_month"],
        },
    )


def sales_attainment(
    sources: Mapping[str, DataFrame],
    as_of: DateLike = None,
    vertical: str = DEFAULT_VERTICAL,
    bounded: bool = False,
) -> DataFrame:
    """The report: one row per tier.

    Opportunities are summed per account before they meet the cohort. The cohort is reduced to one
    row per account and tier with its number of occurrences, so an account listed many
    times is a factor, not a group of rows.
    """
    refs = period_row(sources["calendar"], as_of)
    listed = account_cohort(sources, as_of, vertical).groupBy("crm_account_id", "priority_level").agg(
        F.count("*").alias("listed")
    )
    actuals = opportunity_actuals(sources["opportunity"], refs, bounded)
    per_tier = (
        listed.join(actuals, "crm_account_id", "left")
        .groupBy("priority_level")
        .agg(*[F.sum(scaled(F.col(a), F.col("listed"), actuals.schema[a].dataType)).alias(f"total_{a}") for a in ACTUALS])
    )
    with_targets = attach_row(per_tier, vertical_targets(sources["targets"], refs, as_of, vertical))
    return with_targets.select(
        row_value(refs)["as_of_date"].alias("report_date"),
        "*",
        *[safe_divide(F.col(won), F.col(target)).alias(name) for name, (won, target) in ATTAINMENT.items()],
    ).orderBy("report_date", "priority_level")
