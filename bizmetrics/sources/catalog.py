"""The sixteen source tables and a registry that reads them on demand."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    """Where a table lives in the warehouse by default, and the columns the reports use."""

    warehouse_name: str
    columns: tuple[str, ...]
    dates: tuple[str, ...] = ()


# Default warehouse names and column names.
TABLES: dict[str, Table] = {
    "revenue": Table(
        "data_warehouse.fact_monthly_customer_revenue",
        ("month_end_date", "customer_id", "product_id", "acv", "mrr"),
        dates=("month_end_date",),
    ),
    "hierarchy": Table(
        "data_warehouse.dim_product_hierarchy",
        ("product_id", "product_category", "product_group", "product_name"),
    ),
    "calendar": Table(
        "shared_utils.dim_date",
        ("date", "first_day_of_month", "first_day_of_quarter"),
        dates=("date", "first_day_of_month", "first_day_of_quarter"),
    ),
    "logs": Table(
        "product_db.fact_llm_inference_logs",
        (
            "account_id",
            "model_name",
            "event_timestamp",
            "event_date",
            "error_code",
            "call_weight_from_sampling",
            "input_tokens",
            "output_tokens",
            "time_to_first_token_ms",
            "inference_duration_ms",
        ),
        dates=("event_date",),
    ),
    "accounts_dim": Table(
        "data_warehouse.dim_customer_accounts",
        ("account_id", "industry_vertical", "billing_country"),
    ),
    "users": Table("data_warehouse.dim_users", ("user_id", "account_id", "subscription_plan", "is_active")),
    "accounts": Table("data_warehouse.dim_accounts", ("account_id", "organization_id", "is_active")),
    "orgs": Table("data_warehouse.dim_orgs", ("organization_id", "crm_organization_id")),
    "rules": Table(
        "product_db.fact_firewall_rules_daily",
        ("user_id", "event_date", "uses_heuristic_rule"),
        dates=("event_date",),
    ),
    "analytics": Table(
        "product_db.fact_analytics_records_daily",
        ("user_id", "event_date", "is_proxied"),
        dates=("event_date",),
    ),
    "settings": Table("product_db.comany_settings", ("user_id", "is_js_challenge_enabled")),
    "interactions": Table(
        "analytics_db.dashboard_interactions",
        ("event_date", "properties.user_id", "properties.page_url"),
        dates=("event_date",),
    ),
    "customers": Table("data_warehouse.dim_customer", ("crm_account_id", "account_name", "industry_vertical")),
    "strategic": Table("sales_planning.strategic_accounts", ("crm_account_id", "account_name", "fiscal_year")),
    "opportunity": Table(
        "crm_raw.opportunity",
        (
            "crm_account_id",
            "pipeline_creation_date",
            "close_date",
            "stage_name",
            "opportunity_type",
            "annual_contract_value",
        ),
        dates=("pipeline_creation_date", "close_date"),
    ),
    "targets": Table(
        "sales_planning.vertical_targets",
        ("target_vertical", "target_month", "target_acv"),
        dates=("target_month",),
    ),
}


def _has_column(schema: T.StructType, path: str) -> bool:
    head, _, rest = path.partition(".")
    if head not in schema.names:
        return False
    field_type = schema[head].dataType
    return not rest or (isinstance(field_type, T.StructType) and _has_column(field_type, rest))


def conform(df: DataFrame, name: str) -> DataFrame:
    """Check that ``df`` has the columns of table ``name``, keep only those, and make its dates DATE.

    A timestamp where a date is meant would drop the last day of a closed range.
    """
    table = TABLES[name]
    missing = [c for c in table.columns if not _has_column(df.schema, c)]
    if missing:
        raise ValueError(f"source '{name}' lacks column(s) {', '.join(missing)}; it has {', '.join(df.columns)}")
    kept: list[Column] = []
    for column in dict.fromkeys(c.partition(".")[0] for c in table.columns):
        # A DATE column is left as it is, so that filters on it still prune partitions.
        if column in table.dates and df.schema[column].dataType != T.DateType():
            kept.append(F.col(column).cast("date").alias(column))
        else:
            kept.append(F.col(column))
    return df.select(*kept)


Reader = Callable[[], DataFrame]


class Sources(Mapping[str, DataFrame]):
    """Name → DataFrame. A table is looked up when a report first asks for it, so unused ones may be absent."""

    def __init__(self, readers: Mapping[str, DataFrame | Reader]):
        unknown = set(readers) - set(TABLES)
        if unknown:
            raise KeyError(f"unknown source(s): {', '.join(sorted(unknown))}")
        self._readers = dict(readers)

    @staticmethod
    def warehouse_readers(spark: SparkSession, **names: str) -> dict[str, Reader]:
        return {n: (lambda t=names.get(n, TABLES[n].warehouse_name): spark.table(t)) for n in TABLES}

    @staticmethod
    def parquet_readers(spark: SparkSession, **paths: str) -> dict[str, Reader]:
        return {n: (lambda p=p: spark.read.parquet(p)) for n, p in paths.items()}

    @classmethod
    def from_warehouse(cls, spark: SparkSession, **names: str) -> Sources:
        """Catalog tables under their default names; pass ``logs="db.other_name"`` to read another."""
        return cls(cls.warehouse_readers(spark, **names))

    @classmethod
    def from_parquet(cls, spark: SparkSession, **paths: str) -> Sources:
        """Parquet directories, one path per table."""
        return cls(cls.parquet_readers(spark, **paths))

    def __getitem__(self, name: str) -> DataFrame:
        reader = self._readers[name]
        return conform(reader() if callable(reader) else reader, name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._readers)

    def __len__(self) -> int:
        return len(self._readers)
