"""Every query against its SQL: on the supplied tables, and on random ones full of NULLs, copies and hot keys."""

import datetime
import random
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from parity import connect, differences

import __spark_entry__ as entry_points
from bizmetrics import oracle
from bizmetrics.operators import period_row
from bizmetrics.plans import feature_adoption, hierarchy_growth, model_usage, sales_attainment
from bizmetrics.queries import QUERIES, decimals_as_doubles, users_per_plan
from bizmetrics.sources import Sources, calendar
from bizmetrics.sources.testdata import (
    ADOPTION_AS_OF,
    CATEGORY,
    MODELS,
    OPPORTUNITY_TYPES,
    SALES_AS_OF,
    SALT,
    STAGES,
    USAGE_AS_OF,
    VERTICAL,
    TestTables,
)

DAY = datetime.timedelta(days=1)


@pytest.fixture(scope="module")
def duckdb_small(small_dir):
    return connect(small_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries()) and set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_parity(spark, small_dir, duckdb_small, name):
    assert differences(QUERIES[name](spark, small_dir), duckdb_small, entry_points.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", [n for n in oracle.FIXTURES if not n.endswith("_days")])
def test_source_tables_are_the_same_in_both_engines(spark, small_dir, duckdb_small, name):
    df, sql = TestTables(spark, small_dir).sources()[name], oracle.FIXTURES[name]
    if name == "interactions":
        df = df.select("event_date", "properties.*")
        sql = f"SELECT event_date, properties.user_id AS user_id, properties.page_url AS page_url FROM ({sql})"
    assert differences(df, duckdb_small, sql) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


# --- random tables -------------------------------------------------------------------------


def money(value):
    return None if value is None else Decimal(value).quantize(Decimal("0.01"))


def date(text):
    return datetime.date.fromisoformat(text)


class Random:
    def __init__(self, seed):
        self.r = random.Random(seed)

    def key(self, n, nulls=0.1):
        """One of ``n`` keys; the first holds a third of the rows."""
        if self.r.random() < nulls:
            return None
        return 1 if self.r.random() < 1 / 3 else self.r.randrange(1, n + 1)

    def signed(self, n):
        """As ``key``, with some negative ids; the sign follows from the key."""
        key = self.key(n)
        return -key if key and key % 4 == 0 else key

    def pick(self, values, nulls=0.1):
        return None if self.r.random() < nulls else self.r.choice(list(values))

    def between(self, low, high):
        return low + DAY * self.r.randrange((high - low).days + 1)

    def amount(self):
        return money(self.r.choice([0, 1, -3, 250]) + self.r.randrange(100) / 100)


MONEY = pa.decimal128(18, 2)
SCHEMAS = {
    "revenue": {
        "month_end_date": pa.date32(),
        "customer_id": pa.int64(),
        "product_id": pa.int64(),
        "acv": MONEY,
        "mrr": MONEY,
    },
    "hierarchy": {
        "product_id": pa.int64(),
        "product_category": pa.string(),
        "product_group": pa.string(),
        "product_name": pa.string(),
    },
    "logs": {
        "account_id": pa.int64(),
        "event_timestamp": pa.timestamp("us"),
        "event_date": pa.date32(),
        "model_name": pa.string(),
        "error_code": pa.int32(),
        "call_weight_from_sampling": pa.int64(),
        "input_tokens": pa.int64(),
        "output_tokens": pa.int64(),
        "time_to_first_token_ms": MONEY,
        "inference_duration_ms": MONEY,
    },
    "accounts_dim": {"account_id": pa.int64(), "industry_vertical": pa.string(), "billing_country": pa.string()},
    "users": {
        "user_id": pa.int64(),
        "account_id": pa.int64(),
        "subscription_plan": pa.string(),
        "is_active": pa.bool_(),
    },
    "accounts": {"account_id": pa.int64(), "organization_id": pa.int32(), "is_active": pa.bool_()},
    "orgs": {"organization_id": pa.int32(), "crm_organization_id": pa.string()},
    "rules": {"user_id": pa.int64(), "event_date": pa.date32(), "uses_heuristic_rule": pa.bool_()},
    "analytics": {"user_id": pa.int64(), "event_date": pa.date32(), "is_proxied": pa.bool_()},
    "settings": {"user_id": pa.int64(), "is_js_challenge_enabled": pa.bool_()},
    "interactions": {
        "event_date": pa.date32(),
        "properties": pa.struct({"user_id": pa.int64(), "page_url": pa.string()}),
    },
    "customers": {"crm_account_id": pa.int64(), "account_name": pa.string(), "industry_vertical": pa.string()},
    "strategic": {"crm_account_id": pa.int64(), "account_name": pa.string(), "fiscal_year": pa.int32()},
    "opportunity": {
        "crm_account_id": pa.int64(),
        "pipeline_creation_date": pa.date32(),
        "close_date": pa.date32(),
        "stage_name": pa.string(),
        "opportunity_type": pa.string(),
        "annual_contract_value": MONEY,
    },
    "targets": {"target_vertical": pa.string(), "target_month": pa.date32(), "target_acv": MONEY},
}


def random_tables(seed):
    g = Random(seed)
    flags = [True, False]
    months = [date(f"{y}-{m:02d}-28") for y in (2022, 2023, 2024) for m in range(1, 13)]
    months = [m for m in months if g.r.random() > 0.1]
    usage_low, usage_high = date("2023-12-28"), date("2024-02-03")
    seen_low, seen_high = date("2024-01-20"), date("2024-02-01")
    sales_low, sales_high = date("1999-11-01"), date("2001-12-31")

    def log_row():
        day = g.between(usage_low, usage_high)
        stamp = datetime.datetime.combine(day, datetime.time(g.r.randrange(24), g.r.randrange(60), g.r.randrange(60)))
        return [
            g.key(5),
            stamp,
            day,
            g.pick(MODELS.values()),
            g.pick([0, 0, 0, 1]),
            g.pick(range(1, 12)),
            g.pick(range(1000)),
            g.pick(range(1000)),
            g.pick([g.amount()]),
            g.pick([g.amount()]),
        ]

    return {
        "revenue": [[g.r.choice(months), g.key(9), g.key(14), g.amount(), g.amount()] for _ in range(900)],
        "hierarchy": [
            [p, g.pick([CATEGORY, CATEGORY, "Other"]), g.pick(["G1", "G2"]), g.pick(["N1", "N2", "N3"])]
            for p in [*range(1, 13), 3]
        ],
        "logs": [log_row() for _ in range(1500)],
        "accounts_dim": [[g.key(4), g.pick(["V1", "V2"]), g.pick(["C1", "C2"])] for _ in range(7)],
        "users": [[g.key(60), g.key(6), g.pick(["P1", "P2", "P3"]), g.pick(flags)] for _ in range(150)],
        "accounts": [[a, g.pick([1, 2, 3]), g.pick([True, True, False])] for a in [1, 2, 3, 4, 5, 2]],
        "orgs": [[1, "O1"], [2, None], [4, "O4"], [1, "O1b"], [4, "O4"]],
        "rules": [[g.key(60), g.between(seen_low, seen_high), g.pick(flags)] for _ in range(200)],
        "analytics": [[g.key(60), g.between(seen_low, seen_high), g.pick(flags)] for _ in range(200)],
        "settings": [[g.key(60), g.pick(flags)] for _ in range(40)],
        "interactions": [
            [
                g.between(seen_low, seen_high),
                {"user_id": g.key(60), "page_url": g.pick(["/security/analytics", "/a/security/analytics", "/home"])},
            ]
            for _ in range(60)
        ],
        "customers": [[g.signed(20), g.pick(["A", "B"]), g.pick([VERTICAL, "Other"])] for _ in range(50)],
        "strategic": [[g.signed(20), g.pick(["A", "B"]), g.pick([2001, 2000])] for _ in range(25)],
        "opportunity": [
            [
                g.signed(25),
                g.between(sales_low, sales_high),
                g.between(sales_low, sales_high),
                g.pick(STAGES.values()),
                g.pick([*OPPORTUNITY_TYPES.values(), "Partner"]),
                g.amount(),
            ]
            for _ in range(400)
        ],
        "targets": [
            [g.pick([VERTICAL, "Other"]), date(f"{y}-{m:02d}-01"), g.amount()] for y in (2000, 2001) for m in range(1, 13)
        ],
    }


REPORTS = {
    "r1_business_metrics": lambda s: hierarchy_growth.hierarchy_growth(s, CATEGORY),
    "r2_partner_usage": lambda s: model_usage.model_usage(s, SALT, USAGE_AS_OF),
    "r3_product_adoption": lambda s: feature_adoption.feature_adoption(s, ADOPTION_AS_OF),
    "r4_sales_performance": lambda s: sales_attainment.sales_attainment(s, SALES_AS_OF, VERTICAL),
    "s08_hourly_volume": lambda s: model_usage.hourly_volume(
        model_usage.calls_by_hour(s, USAGE_AS_OF), s["accounts_dim"], SALT
    ),
    "s09_usage_percentiles": lambda s: model_usage.volume_percentiles(
        model_usage.calls_by_hour(s, USAGE_AS_OF), s["accounts_dim"], SALT
    ),
    "s05_hierarchy_grouping_sets": lambda s: hierarchy_growth.level_metrics(hierarchy_growth.revenue_base(s, CATEGORY)),
    "s10_usage_summary": lambda s: model_usage.usage_summary(model_usage.calls_by_hour(s, USAGE_AS_OF), SALT),
    "s12_active_entities": feature_adoption.active_entities,
    "s13_feature_flags": lambda s: feature_adoption.user_flags_per_setting(s, ADOPTION_AS_OF),
    "s15_plan_totals": lambda s: feature_adoption.plan_totals(feature_adoption.active_entities(s)),
    "s18_opportunity_actuals": lambda s: sales_attainment.opportunity_actuals(
        s["opportunity"], period_row(s["calendar"], SALES_AS_OF)
    ),
    "s19_vertical_targets": lambda s: sales_attainment.vertical_targets(
        s["targets"], period_row(s["calendar"], SALES_AS_OF), SALES_AS_OF, VERTICAL
    ),
    "s14_adoption_long": lambda s: feature_adoption.adoption_long(feature_adoption.user_flags(s, ADOPTION_AS_OF)),
    "s16_cohort": lambda s: sales_attainment.account_cohort(s, SALES_AS_OF, VERTICAL),
}


@pytest.fixture(scope="module", params=[1, 2, 3])
def random_sources(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp(f"random{request.param}")
    for name, rows in random_tables(request.param).items():
        columns = SCHEMAS[name]
        data = {c: pa.array([r[i] for r in rows], columns[c]) for i, c in enumerate(columns)}
        pq.write_table(pa.table(data), folder / f"{name}.parquet")
    files = {name: str(folder / f"{name}.parquet") for name in SCHEMAS}
    opened = Sources.from_parquet(spark, **files)
    sources = {name: opened[name] for name in SCHEMAS}
    sources["calendar"] = calendar(spark, "1995-01-01", "2024-12-31")
    fixtures = {name: f"SELECT * FROM '{path}'" for name, path in files.items()}
    fixtures["event_days"] = f"SELECT DISTINCT event_date AS date FROM '{files['logs']}'"
    return sources, oracle.oracle_sql({**oracle.FIXTURES, **fixtures})


@pytest.mark.parametrize("name", list(REPORTS))
def test_random_parity(random_sources, small_dir, name):
    sources, sql = random_sources
    assert differences(decimals_as_doubles(REPORTS[name](sources)), connect(small_dir), sql[name]) == []


@pytest.mark.parametrize("name", ["s16_cohort", "r4_sales_performance"])
def test_text_ids(spark, small_dir, tmp_path, name):
    """Ids of a customer system may be text, negative numbers among them."""
    schemas = {n: {c: pa.string() if c == "crm_account_id" else t for c, t in columns.items()} for n, columns in SCHEMAS.items()}
    rows = random_tables(4)
    for table in ("customers", "strategic", "opportunity"):
        rows[table] = [[None if r[0] is None else f"crm{r[0]}", *r[1:]] for r in rows[table]]
    files = {}
    for table, columns in schemas.items():
        files[table] = str(tmp_path / f"{table}.parquet")
        pq.write_table(pa.table({c: pa.array([r[i] for r in rows[table]], columns[c]) for i, c in enumerate(columns)}), files[table])
    opened = Sources.from_parquet(spark, **files)
    sources = {table: opened[table] for table in SCHEMAS} | {"calendar": calendar(spark, "1995-01-01", "2024-12-31")}
    sql = oracle.oracle_sql({**oracle.FIXTURES, **{table: f"SELECT * FROM '{path}'" for table, path in files.items()}})
    assert differences(decimals_as_doubles(REPORTS[name](sources)), connect(small_dir), sql[name]) == []


@pytest.mark.parametrize("users, accounts", [([], []), ([[1, 1, "P1", False]], [[1, 1, True]]), ([[1, 1, "P1", True]], [[1, 1, False]])])
def test_nobody_is_active(spark, tmp_path, users, accounts):
    """The total is there in both engines, with zeros."""
    import duckdb

    connection, sources, fixtures = duckdb.connect(), {}, {}
    for name in ("users", "accounts", "orgs", "rules", "analytics", "settings", "interactions"):
        rows = {"users": users, "accounts": accounts}.get(name, [])
        columns = SCHEMAS[name]
        path = tmp_path / f"{name}.parquet"
        pq.write_table(pa.table({c: pa.array([r[i] for r in rows], columns[c]) for i, c in enumerate(columns)}), path)
        sources[name], fixtures[name] = spark.read.parquet(str(path)), f"SELECT * FROM '{path}'"
    sql = oracle.oracle_sql({**oracle.FIXTURES, **fixtures})
    for name in ("s15_plan_totals", "r3_product_adoption"):
        assert differences(REPORTS[name](sources), connection, sql[name]) == []
    assert [(r["plan"], r["is_total"], r["n_users"]) for r in users_per_plan(sources["users"].where("user_id < 0")).collect()] == [("All", 1, 0)]
