"""The sixteen source tables, derived from the supplied test tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizmetrics.sources.calendar import calendar, calendar_of
from bizmetrics.sources.catalog import Sources

# Fixed parameters of the test reports.
CATEGORY = "PROMO"
USAGE_AS_OF = "2024-02-15"
ADOPTION_AS_OF = "2024-01-31"
SALES_AS_OF = "2001-05-15"
VERTICAL = "BUILDING"
STRATEGIC_YEAR = 2001
SALT = "pepper-for-tests"

MODELS = {
    "click": "partner-a/model-family-x-1",
    "view": "partner-a/model-family-y-1",
    "purchase": "partner-a/model-family-x-2",
    "signup": "partner-b/other-1",
    "error": "partner-a/model-family-x-1",
}
STAGES = {"F": "Closed Won", "P": "Closed Lost", "O": "Open"}
OPPORTUNITY_TYPES = {
    "1-URGENT": "New Business",
    "2-HIGH": "Upsell",
    "3-MEDIUM": "Cross-sell",
    "4-NOT SPECIFIED": "Renewal",
    "5-LOW": "Internal",
}


def money(name: str):
    return F.col(name).cast("decimal(18,2)")


def mapped(name: str, values: dict[str, str]):
    branches = F.lit(None).cast("string")
    for key, value in values.items():
        branches = F.when(F.col(name) == key, value).otherwise(branches)
    return branches


class TestTables:
    """Reads one scale-factor directory; every method is lazy."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        # Opening a parquet table reads a footer to learn its schema: once per table is enough.
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def sources(self) -> Sources:
        return Sources(
            {
                "revenue": self.revenue,
                "hierarchy": self.hierarchy,
                "calendar": self.calendar,
                "logs": self.logs,
                "accounts_dim": self.accounts_dim,
                "users": self.users,
                "accounts": self.accounts,
                "orgs": self.orgs,
                "rules": self.rules,
                "analytics": self.analytics,
                "settings": self.settings,
                "interactions": self.interactions,
                "customers": self.customers,
                "strategic": self.strategic,
                "opportunity": self.opportunity,
                "targets": self.targets,
            }
        )

    def revenue(self) -> DataFrame:
        months = self.read("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.last_day(F.col("o_orderdate").cast("date")).alias("month_end_date"),
            F.col("o_custkey").alias("customer_id"),
        )
        return (
            self.read("lineitem")
            .join(months, "l_orderkey")
            .select(
                "month_end_date",
                "customer_id",
                F.col("l_partkey").alias("product_id"),
                money("l_extendedprice").alias("acv"),
                money("l_quantity").alias("mrr"),
            )
        )

    def hierarchy(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category"),
            F.col("p_brand").alias("product_group"),
            F.col("p_name").alias("product_name"),
        )

    def calendar(self) -> DataFrame:
        """Every day from 1995 to the end of the current year, so that any report date up to today has its row."""
        return calendar(self.spark, "1995-01-01", f"{datetime.date.today().year}-12-31")

    def event_calendar(self) -> DataFrame:
        return calendar_of(self.read("events"), F.col("ts"))

    def order_calendar(self) -> DataFrame:
        return calendar_of(self.read("orders"), F.col("o_orderdate"))

    def logs(self) -> DataFrame:
        value = money("value")
        return self.read("events").select(
            F.nullif(F.col("user_id"), F.lit(0)).alias("account_id"),
            F.col("ts").alias("event_timestamp"),
            F.col("ts").cast("date").alias("event_date"),
            mapped("event_type", MODELS).alias("model_name"),
            F.when(F.col("event_type") == "error", 1).otherwise(0).alias("error_code"),
            (F.col("event_id") % 10 + 1).alias("call_weight_from_sampling"),
            (F.col("event_id") % 997).alias("input_tokens"),
            (F.col("event_id") % 499).alias("output_tokens"),
            value.alias("time_to_first_token_ms"),
            (value + (F.col("event_id") % 7).cast("decimal(18,2)"))
            .cast("decimal(18,2)")
            .alias("inference_duration_ms"),
        )

    def accounts_dim(self) -> DataFrame:
        """Customers with a balance that is not negative; the others' usage finds no account row."""
        nations = self.read("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("billing_country")
        )
        return (
            self.read("customer")
            .where(F.col("c_acctbal") >= 0)
            .join(nations, "c_nationkey")
            .select(
                F.col("c_custkey").alias("account_id"),
                F.col("c_mktsegment").alias("industry_vertical"),
                "billing_country",
            )
        )

    def users(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("user_id"),
            (F.col("c_custkey") % 10).alias("account_id"),
            F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("subscription_plan"),
            (F.col("c_acctbal") > 0).alias("is_active"),
        )

    def accounts(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias("account_id"),
            F.col("s_nationkey").alias("organization_id"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )

    def orgs(self) -> DataFrame:
        """Nations outside region 0; accounts of the others fall back to their own id."""
        return (
            self.read("nation")
            .where(F.col("n_regionkey") != 0)
            .select(F.col("n_nationkey").alias("organization_id"), F.col("n_name").alias("crm_organization_id"))
        )

    def _events_of(self, event_type: str) -> DataFrame:
        return (
            self.read("events")
            .where(F.col("event_type") == event_type)
            .withColumn("event_date", F.col("ts").cast("date"))
        )

    def rules(self) -> DataFrame:
        uses = F.when(F.col("event_id") % 5 != 0, F.col("value") > 50)
        return self._events_of("error").select("user_id", "event_date", uses.alias("uses_heuristic_rule"))

    def analytics(self) -> DataFrame:
        return self._events_of("view").select("user_id", "event_date", (F.col("value") > 20).alias("is_proxied"))

    def settings(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_custkey").alias("user_id"),
            (F.col("o_orderpriority") == "1-URGENT").alias("is_js_challenge_enabled"),
        )

    def interactions(self) -> DataFrame:
        page = F.when(F.col("event_id") % 2 == 0, "/z/security/analytics").otherwise("/z/home")
        return self._events_of("click").select(
            "event_date", F.struct("user_id", page.alias("page_url")).alias("properties")
        )

    def customers(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("crm_account_id"),
            F.col("c_name").alias("account_name"),
            F.col("c_mktsegment").alias("industry_vertical"),
        )

    def strategic(self) -> DataFrame:
        return (
            self.read("customer")
            .where(F.col("c_acctbal") > 8000)
            .select(
                F.col("c_custkey").alias("crm_account_id"),
                F.col("c_name").alias("account_name"),
                F.lit(STRATEGIC_YEAR).alias("fiscal_year"),
            )
        )

    def opportunity(self) -> DataFrame:
        created = F.col("o_orderdate").cast("date")
        return self.read("orders").select(
            F.col("o_custkey").alias("crm_account_id"),
            created.alias("pipeline_creation_date"),
            F.date_add(created, (F.col("o_orderkey") % 90).cast("int")).alias("close_date"),
            mapped("o_orderstatus", STAGES).alias("stage_name"),
            mapped("o_orderpriority", OPPORTUNITY_TYPES).alias("opportunity_type"),
            money("o_totalprice").alias("annual_contract_value"),
        )

    def targets(self) -> DataFrame:
        """Each vertical's monthly order total. Orders are summed per customer before the join."""
        per_customer = (
            self.read("orders")
            .groupBy(
                F.col("o_custkey").alias("c_custkey"),
                F.trunc(F.col("o_orderdate").cast("date"), "month").alias("target_month"),
            )
            .agg(F.sum(money("o_totalprice")).alias("target_acv"))
        )
        return (
            per_customer.join(self.read("customer"), "c_custkey")
            .groupBy(F.col("c_mktsegment").alias("target_vertical"), "target_month")
            .agg(F.sum("target_acv").cast("decimal(18,2)").alias("target_acv"))
        )
