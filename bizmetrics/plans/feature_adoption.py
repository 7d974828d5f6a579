"""Share of active users, accounts and organisations per plan that adopted each feature."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizmetrics.functions import safe_divide
from bizmetrics.functions.dates import DateLike
from bizmetrics.operators.adoption import (
    flags_to_long,
    join_member_counts,
    membership_flags,
    metric_rows,
    repeat_rows,
    rollup_distinct,
)
from bizmetrics.operators.periods import report_date

# Labels and output names. The labels are the report's own and do not all
# describe their source: "Analytics Dashboard" counts proxied traffic.
FLAGS = {
    "is_adopted_ai_powered_waf_rule": "Heuristic Rule",
    "is_adopted_volumetric_protection": "Analytics Dashboard",
    "is_adopted_client_side_analysis": "Company Setting",
    "is_adopted_security_dashboard_ui": "UI Interactions",
}
RULE, PROXY, SETTING, DASHBOARD = FLAGS
SCENARIO = "Adopted vs. Total Active"
TOTAL_LABEL = "All"
DASHBOARD_PAGE = "/security/analytics"
DASHBOARD_DAYS = 7

PLAN = "subscription_plan"
ENTITIES = {"users": "user_id", "accounts": "account_id", "orgs": "organization_id"}
ADOPTED = {entity: f"adopted_{entity}" for entity in ENTITIES}
TOTAL = {entity: f"total_{entity}" for entity in ENTITIES}


def active_entities(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Active users of active accounts; an account without an organisation stands for itself.

    Organisations are joined to accounts first, as there are fewer accounts than users.
    """
    accounts = (
        sources["accounts"]
        .where("is_active")
        .join(sources["orgs"], "organization_id", "left")
        .select(
            "account_id",
            F.coalesce("crm_organization_id", F.col("account_id").cast("string")).alias("organization_id"),
        )
    )
    users = sources["users"].where("is_active").select(PLAN, "user_id", "account_id")
    return users.join(accounts, "account_id").select(PLAN, *ENTITIES.values())


def adopters(sources: Mapping[str, DataFrame], as_of: DateLike = None) -> dict[str, DataFrame]:
    """Users seen with each feature, one row per sighting; flag → relation with ``user_id``."""
    day = report_date(as_of)
    on_day = F.col("event_date") == day
    # Closed on both sides: the report date and the 7 days before it.
    recent = F.col("event_date").between(F.date_sub(day, DASHBOARD_DAYS), day)
    return {
        # A user's rule flags are combined by OR, and none or only NULLs count as not adopted.
        RULE: sources["rules"].where(on_day & F.col("uses_heuristic_rule")).select("user_id"),
        PROXY: sources["analytics"].where(on_day & F.col("is_proxied")).select("user_id"),
        SETTING: sources["settings"].where("is_js_challenge_enabled").select("user_id"),
        DASHBOARD: sources["interactions"]
        .where(recent & F.col("properties.page_url").endswith(DASHBOARD_PAGE))
        .select("properties.user_id"),
    }


def user_flags(sources: Mapping[str, DataFrame], as_of: DateLike = None) -> DataFrame:
    """Active users with a boolean per feature. Rows are not repeated, however often a feature was seen."""
    return membership_flags(active_entities(sources), adopters(sources, as_of), "user_id")


def user_flags_per_setting(sources: Mapping[str, DataFrame], as_of: DateLike = None) -> DataFrame:
    """``user_flags`` with a user's row repeated for each of their enabled settings rows.

    Distinct counts don't see the difference, so the report does without the repetition.
    """
    counted = join_member_counts(active_entities(sources), adopters(sources, as_of), "user_id")
    repeated = repeat_rows(counted, F.greatest(SETTING, F.lit(1)))
    return repeated.withColumns({flag: F.col(flag) > 0 for flag in FLAGS})


def adoption_long(flags: DataFrame) -> DataFrame:
    """Feature × plan: distinct adopting users, accounts and organisations. No row where there are none."""
    counts = rollup_distinct(flags, PLAN, ENTITIES, {f: f for f in FLAGS}, with_total=False)
    return flags_to_long(counts, [PLAN], FLAGS, ADOPTED).select("metric_name", PLAN, *ADOPTED.values())


def _plan_label(is_total: str = "is_total"):
    return F.when(F.col(is_total) == 1, TOTAL_LABEL).otherwise(F.col(PLAN))


def plan_totals(entities: DataFrame) -> DataFrame:
    """Distinct active users, accounts and organisations per plan and over all plans ('All')."""
    counts = rollup_distinct(entities, PLAN, ENTITIES, {})
    return counts.select(_plan_label().alias(PLAN), *TOTAL.values())


def feature_adoption(
    sources: Mapping[str, DataFrame], as_of: DateLike = None, rollup_adoption: bool = False
) -> DataFrame:
    """The report: ``plan_totals`` left-joined to ``adoption_long`` on the plan label.

    Both come from one pass over the flagged users, so the join is a matter of labels:

    * The 'All' row has no adoption counts of its own, as these exist per plan only: its metric is
      NULL and its counts are 0. With ``rollup_adoption`` it gets those over all plans.
    * A plan that is NULL matches nothing and has one row with a NULL metric.
    * Should a plan be called 'All', the total matches that plan's counts, as its label does.
    """
    counts = rollup_distinct(user_flags(sources, as_of), PLAN, ENTITIES, {f: f for f in FLAGS})
    by_label = counts.select(
        "is_total",
        _plan_label().alias("label"),
        F.col(PLAN).isNotNull().alias("is_plan"),
        *TOTAL.values(),
        metric_rows(FLAGS, ADOPTED).alias("metrics"),
    )
    if rollup_adoption:
        matched = F.when(F.col("is_plan") | (F.col("is_total") == 1), F.col("metrics"))
    else:
        # One row per label, but for a plan called 'All', so these partitions are tiny.
        of_plan = F.when((F.col("is_total") == 0) & F.col("is_plan"), F.col("metrics"))
        matched = F.first(of_plan, ignorenulls=True).over(Window.partitionBy("label"))
    rows = by_label.select("label", *TOTAL.values(), matched.alias("matched")).select(
        "label", *TOTAL.values(), F.explode_outer("matched").alias("m")
    )
    adopted = {entity: F.coalesce(F.col("m")[name], F.lit(0)) for entity, name in ADOPTED.items()}
    return rows.select(
        report_date(as_of).alias("report_date"),
        F.lit(SCENARIO).alias("scenario"),
        F.col("label").alias(PLAN),
        F.col("m.metric_name").alias("metric_name"),
        *[column.alias(ADOPTED[entity]) for entity, column in adopted.items()],
        *TOTAL.values(),
        *[
            safe_divide(adopted[entity], F.col(TOTAL[entity])).alias(f"pct_adoption_{entity}")
            for entity in ENTITIES
        ],
    ).orderBy(PLAN, "metric_name")

