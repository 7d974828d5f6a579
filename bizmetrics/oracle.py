"""The same queries in DuckDB SQL, written from their definitions rather than from the Spark code.

Where there is a choice, the SQL takes another route than Spark does: one statement per
hierarchy level in place of grouping sets, numbered rows joined to themselves in place of LAG, EXISTS
in place of joined flags, the dimension joined before sums in place of after them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from bizmetrics.sources.testdata import (
    ADOPTION_AS_OF,
    CATEGORY,
    MODELS,
    OPPORTUNITY_TYPES,
    SALES_AS_OF,
    SALT,
    STAGES,
    STRATEGIC_YEAR,
    USAGE_AS_OF,
    VERTICAL,
)


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


# The source tables, each as a SELECT over the test tables.
FIXTURES = {
    "revenue": """
        SELECT last_day(o.o_orderdate::DATE) AS month_end_date, o.o_custkey AS customer_id,
               l.l_partkey AS product_id, l.l_extendedprice::DECIMAL(18,2) AS acv,
               l.l_quantity::DECIMAL(18,2) AS mrr
        FROM lineitem l, orders o WHERE l.l_orderkey = o.o_orderkey""",
    "hierarchy": """
        SELECT p_partkey AS product_id, p_type AS product_category, p_brand AS product_group,
               p_name AS product_name FROM part""",
    "event_days": "SELECT DISTINCT ts::DATE AS date FROM events",
    "order_days": "SELECT DISTINCT o_orderdate::DATE AS date FROM orders",
    "logs": f"""
        SELECT NULLIF(user_id, 0) AS account_id, ts AS event_timestamp, ts::DATE AS event_date,
               {_case("event_type", MODELS)} AS model_name,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS error_code,
               event_id % 10 + 1 AS call_weight_from_sampling, event_id % 997 AS input_tokens,
               event_id % 499 AS output_tokens, value::DECIMAL(18,2) AS time_to_first_token_ms,
               (value::DECIMAL(18,2) + (event_id % 7)::DECIMAL(18,2))::DECIMAL(18,2) AS inference_duration_ms
        FROM events""",
    "accounts_dim": """
        SELECT c_custkey AS account_id, c_mktsegment AS industry_vertical, n_name AS billing_country
        FROM customer, nation WHERE c_nationkey = n_nationkey AND c_acctbal >= 0""",
    "users": """
        SELECT c_custkey AS user_id, c_custkey % 10 AS account_id,
               NULLIF(c_mktsegment, 'MACHINERY') AS subscription_plan, c_acctbal > 0 AS is_active
        FROM customer""",
    "accounts": """
        SELECT s_suppkey AS account_id, s_nationkey AS organization_id, s_acctbal > 0 AS is_active
        FROM supplier""",
    "orgs": """
        SELECT n_nationkey AS organization_id, n_name AS crm_organization_id
        FROM nation WHERE n_regionkey <> 0""",
    "rules": """
        SELECT user_id, ts::DATE AS event_date,
               CASE WHEN event_id % 5 <> 0 THEN value > 50 END AS uses_heuristic_rule
        FROM events WHERE event_type = 'error'""",
    "analytics": """
        SELECT user_id, ts::DATE AS event_date, value > 20 AS is_proxied
        FROM events WHERE event_type = 'view'""",
    "settings": """
        SELECT o_custkey AS user_id, o_orderpriority = '1-URGENT' AS is_js_challenge_enabled FROM orders""",
    "interactions": """
        SELECT ts::DATE AS event_date, struct_pack(user_id := user_id, page_url :=
               CASE WHEN event_id % 2 = 0 THEN '/z/security/analytics' ELSE '/z/home' END) AS properties
        FROM events WHERE event_type = 'click'""",
    "customers": """
        SELECT c_custkey AS crm_account_id, c_name AS account_name, c_mktsegment AS industry_vertical
        FROM customer""",
    "strategic": f"""
        SELECT c_custkey AS crm_account_id, c_name AS account_name, {STRATEGIC_YEAR} AS fiscal_year
        FROM customer WHERE c_acctbal > 8000""",
    "opportunity": f"""
        SELECT o_custkey AS crm_account_id, o_orderdate::DATE AS pipeline_creation_date,
               o_orderdate::DATE + (o_orderkey % 90)::INTEGER AS close_date,
               {_case("o_orderstatus", STAGES)} AS stage_name,
               {_case("o_orderpriority", OPPORTUNITY_TYPES)} AS opportunity_type,
               o_totalprice::DECIMAL(18,2) AS annual_contract_value
        FROM orders""",
    "targets": """
        SELECT c_mktsegment AS target_vertical, date_trunc('month', o_orderdate)::DATE AS target_month,
               SUM(o_totalprice::DECIMAL(18,2))::DECIMAL(18,2) AS target_acv
        FROM orders, customer WHERE o_custkey = c_custkey GROUP BY ALL""",
}

# Steps that several queries share.
STEPS = {
    "base": f"""
        SELECT month_end_date, customer_id, product_category, product_group, product_name, acv, mrr
        FROM revenue LEFT JOIN hierarchy USING (product_id) WHERE product_category = '{CATEGORY}'""",
    "levels": " UNION ALL ".join(
        f"""
        SELECT month_end_date, '{label}' AS aggregation_level, {column} AS aggregation_object,
               COUNT(DISTINCT customer_id) AS num_customers, SUM(acv) AS acv, SUM(mrr) AS mrr
        FROM base GROUP BY month_end_date, {column}"""
        for label, column in {
            "Product Group": "product_group",
            "Product Name": "product_name",
            "Product Category": "product_category",
        }.items()
    ),
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY aggregation_level, aggregation_object
                                     ORDER BY month_end_date) AS n FROM levels""",
    "yoy": """
        SELECT now.month_end_date, now.aggregation_level, now.aggregation_object, now.num_customers,
               now.acv, now.mrr, ago.num_customers AS customers_ago, ago.acv AS acv_ago, ago.mrr AS mrr_ago
        FROM numbered now LEFT JOIN numbered ago
          ON now.aggregation_level = ago.aggregation_level
         AND now.aggregation_object IS NOT DISTINCT FROM ago.aggregation_object
         AND now.n = ago.n + 12""",
    "yoy_by_calendar": """
        SELECT now.month_end_date, now.aggregation_level, now.aggregation_object, now.num_customers,
               now.acv, now.mrr, ago.num_customers AS customers_ago, ago.acv AS acv_ago, ago.mrr AS mrr_ago
        FROM levels now LEFT JOIN levels ago
          ON now.aggregation_level = ago.aggregation_level
         AND now.aggregation_object IS NOT DISTINCT FROM ago.aggregation_object
         AND year(now.month_end_date) = year(ago.month_end_date) + 1
         AND month(now.month_end_date) = month(ago.month_end_date)""",
    "buckets": f"""
        SELECT date, make_date(year(date), month(date), ((day(date) - 1) // 7 * 7 + 1)::INTEGER) AS week_start
        FROM event_days
        WHERE date_trunc('month', date) = date_trunc('month', DATE '{USAGE_AS_OF}' - INTERVAL 1 MONTH)""",
    "calls": f"""
        SELECT week_start,
               CASE WHEN day(week_start) = 29 OR day(last_day(week_start)) < day(week_start) + 6
                    THEN last_day(week_start) ELSE week_start + 6 END AS week_end,
               sha256('{SALT}' || account_id::VARCHAR) AS customer_uuid, model_name AS model, logs.*
        FROM logs, buckets
        WHERE event_date = date AND error_code = 0
          AND regexp_matches(model_name, '^partner-a/model-family-[xy]-')""",
    "hours": """
        SELECT week_start, week_end, customer_uuid, model, industry_vertical, billing_country,
               date_trunc('hour', event_timestamp)::TIMESTAMP AS hour_bucket, SUM(call_weight_from_sampling)::BIGINT AS calls
        FROM calls LEFT JOIN accounts_dim USING (account_id) GROUP BY ALL""",
    "hour_stats": """
        SELECT week_start, customer_uuid, model, industry_vertical, billing_country,
               quantile_disc(calls, [0.2, 0.5, 0.8]) AS q, MAX(calls) AS peak
        FROM hours GROUP BY ALL""",
    "totals": """
        SELECT week_start, week_end, customer_uuid, model,
               SUM(input_tokens)::BIGINT AS input_tokens, SUM(output_tokens)::BIGINT AS output_tokens,
               SUM(call_weight_from_sampling)::BIGINT AS calls, SUM(time_to_first_token_ms)::DOUBLE / COUNT(time_to_first_token_ms) AS ttft,
               SUM(inference_duration_ms)::DOUBLE / COUNT(inference_duration_ms) AS duration
        FROM calls GROUP BY ALL""",
    "active": """
        SELECT u.subscription_plan, u.user_id, a.account_id,
               COALESCE(o.crm_organization_id, a.account_id::VARCHAR) AS organization_id
        FROM users u JOIN accounts a ON u.account_id = a.account_id
        LEFT JOIN orgs o ON a.organization_id = o.organization_id
        WHERE u.is_active AND a.is_active""",
    "flagged": f"""
        SELECT b.*,
               COALESCE(user_id IN (SELECT user_id FROM rules
                                    WHERE uses_heuristic_rule AND event_date = DATE '{ADOPTION_AS_OF}' - 1), false)
                   AS is_adopted_ai_powered_waf_rule,
               COALESCE(user_id IN (SELECT user_id FROM analytics
                                    WHERE is_proxied AND event_date = DATE '{ADOPTION_AS_OF}' - 1), false)
                   AS is_adopted_volumetric_protection,
               COALESCE(user_id IN (SELECT user_id FROM settings WHERE is_js_challenge_enabled), false)
                   AS is_adopted_client_side_analysis,
               COALESCE(user_id IN (SELECT properties.user_id FROM interactions
                                    WHERE regexp_matches(properties.page_url, '/security/analytics$')
                                      AND event_date >= DATE '{ADOPTION_AS_OF}' - 8
                                      AND event_date < DATE '{ADOPTION_AS_OF}'), false)
                   AS is_adopted_security_dashboard_ui
        FROM active b""",
    "adopted_or_all": """
        SELECT * FROM adopted
        UNION ALL
        SELECT metric_name, 'All', COUNT(DISTINCT user_id), COUNT(DISTINCT account_id), COUNT(DISTINCT organization_id)
        FROM adopters GROUP BY metric_name""",
    "adopters": """
        SELECT * FROM (SELECT *, unnest([
                  {'metric_name': 'Heuristic Rule', 'flag': is_adopted_ai_powered_waf_rule},
                  {'metric_name': 'Analytics Dashboard', 'flag': is_adopted_volumetric_protection},
                  {'metric_name': 'Company Setting', 'flag': is_adopted_client_side_analysis},
                  {'metric_name': 'UI Interactions', 'flag': is_adopted_security_dashboard_ui}], recursive := true)
              FROM flagged)
        WHERE flag""",
    "adopted": """
        SELECT metric_name, subscription_plan, COUNT(DISTINCT user_id) AS adopted_users,
               COUNT(DISTINCT account_id) AS adopted_accounts, COUNT(DISTINCT organization_id) AS adopted_orgs
        FROM adopters GROUP BY ALL""",
    "plans": """
        SELECT subscription_plan, COUNT(DISTINCT user_id) AS total_users,
               COUNT(DISTINCT account_id) AS total_accounts, COUNT(DISTINCT organization_id) AS total_orgs
        FROM active GROUP BY subscription_plan
        UNION ALL
        SELECT 'All', COUNT(DISTINCT user_id), COUNT(DISTINCT account_id), COUNT(DISTINCT organization_id)
        FROM active""",
    "cohort": f"""
        SELECT crm_account_id, account_name, 'Tier 2' AS priority_level
        FROM customers WHERE crm_account_id IS NOT NULL AND industry_vertical = '{VERTICAL}' GROUP BY ALL
        UNION ALL
        SELECT crm_account_id, account_name, 'Tier 1' FROM strategic
        WHERE fiscal_year = year(DATE '{SALES_AS_OF}')""",
    "period": f"""
        SELECT d AS as_of_date, date_trunc('month', d)::DATE AS first_day_of_current_month,
               date_trunc('quarter', d)::DATE AS first_day_of_current_quarter,
               make_date(year(d), 1, 1) AS first_day_of_current_year,
               make_date(year(d) - 1, 1, 1) AS first_day_of_prior_year,
               make_date(year(d) - 1, 12, 31) AS last_day_of_prior_year,
               quarter(d)::INTEGER AS current_quarter_number
        FROM (SELECT DATE '{SALES_AS_OF}' - 1 AS d)""",
    "deals": """
        SELECT crm_account_id, pipeline_creation_date AS created, close_date AS closed,
               annual_contract_value AS acv, stage_name = 'Closed Won' AS won, period.*
        FROM opportunity, period
        WHERE opportunity_type IN ('New Business', 'Upsell', 'Cross-sell', 'Renewal')""",
    "goal": f"""
        SELECT SUM(target_acv) AS annual,
               SUM(IF(quarter(target_month) = current_quarter_number, target_acv, 0)) AS quarterly,
               SUM(IF(target_month = first_day_of_current_month, target_acv, 0)) AS monthly
        FROM targets, period
        WHERE target_vertical = '{VERTICAL}' AND year(target_month) = year(DATE '{SALES_AS_OF}')""",
}

# What each step reads, in an order in which the definitions can be listed.
NEEDS = {
    "base": ["revenue", "hierarchy"],
    "levels": ["base"],
    "numbered": ["levels"],
    "yoy": ["numbered"],
    "yoy_by_calendar": ["levels"],
    "buckets": ["event_days"],
    "calls": ["logs", "buckets"],
    "hours": ["calls", "accounts_dim"],
    "hour_stats": ["hours"],
    "totals": ["calls"],
    "active": ["users", "accounts", "orgs"],
    "flagged": ["active", "rules", "analytics", "settings", "interactions"],
    "adopters": ["flagged"],
    "adopted": ["adopters"],
    "adopted_or_all": ["adopted"],
    "plans": ["active"],
    "cohort": ["customers", "strategic"],
    "deals": ["opportunity", "period"],
    "account_sums": ["deals"],
    "account_sums_bounded": ["deals"],
    "goal": ["targets", "period"],
}


@dataclass(frozen=True)
class Query:
    """A statement and the steps and source tables it reads."""

    names: str
    body: str

    def sql(self, fixtures: Mapping[str, str]) -> str:
        """The statement preceded by the definitions of its names and of everything they read."""
        ordered: list[str] = []

        def add(name: str) -> None:
            for needed in NEEDS.get(name, []):
                add(needed)
            if name not in ordered:
                ordered.append(name)

        for name in self.names.split():
            add(name)
        definitions = [f"{n} AS ({(STEPS[n] if n in STEPS else fixtures[n]).strip()})" for n in ordered]
        return ("WITH " + ",\n".join(definitions) + "\n" if definitions else "") + self.body.strip()


def _ratio(a: str, b: str) -> str:
    return f"({a})::DOUBLE / NULLIF(({b})::DOUBLE, 0)"


_YOY = """month_end_date, aggregation_level, aggregation_object, num_customers, acv::DOUBLE AS total_acv,
    mrr::DOUBLE AS total_mrr, customers_ago AS num_customers_prior_year,
    acv_ago::DOUBLE AS total_acv_prior_year, mrr_ago::DOUBLE AS total_mrr_prior_year"""


def _level(label: str, column: str) -> Query:
    return Query(
        "levels",
        f"""SELECT month_end_date, aggregation_object AS {column}, num_customers,
                   acv::DOUBLE AS total_acv, mrr::DOUBLE AS total_mrr
            FROM levels WHERE aggregation_level = '{label}'""",
    )


# The names of the sums.
ACTUALS = (
    "prior_year_pipeline_acv",
    "prior_year_closed_won_acv",
    "ytd_pipeline_acv",
    "ytd_closed_won_acv",
    "qtd_pipeline_acv",
    "qtd_closed_won_acv",
    "mtd_pipeline_acv",
    "mtd_closed_won_acv",
)


def _growth(step: str) -> Query:
    return Query(
        step,
        f"""SELECT {_YOY},
                   {_ratio("num_customers - customers_ago", "customers_ago")} AS yoy_growth_customers,
                   {_ratio("acv - acv_ago", "acv_ago")} AS yoy_growth_acv,
                   {_ratio("mrr - mrr_ago", "mrr_ago")} AS yoy_growth_mrr
            FROM {step}""",
    )


def _adoption(step: str) -> Query:
    return Query(
        f"{step} plans",
        f"""SELECT DATE '{ADOPTION_AS_OF}' - 1 AS report_date, 'Adopted vs. Total Active' AS scenario, *,
                   adopted_users::DOUBLE / NULLIF(total_users, 0) AS pct_adoption_users,
                   adopted_accounts::DOUBLE / NULLIF(total_accounts, 0) AS pct_adoption_accounts,
                   adopted_orgs::DOUBLE / NULLIF(total_orgs, 0) AS pct_adoption_orgs
            FROM (SELECT t.subscription_plan, a.metric_name, COALESCE(a.adopted_users, 0) AS adopted_users,
                         COALESCE(a.adopted_accounts, 0) AS adopted_accounts,
                         COALESCE(a.adopted_orgs, 0) AS adopted_orgs,
                         t.total_users, t.total_accounts, t.total_orgs
                  FROM plans t LEFT JOIN {step} a ON t.subscription_plan = a.subscription_plan)""",
    )


def _attainment(step: str) -> Query:
    return Query(
        f"cohort {step} goal",
        f"""SELECT (SELECT as_of_date FROM period) AS report_date, priority_level,
                   {", ".join(f"total_{a}::DOUBLE AS total_{a}" for a in ACTUALS)},
                   annual::DOUBLE AS total_annual_target_acv, quarterly::DOUBLE AS current_quarter_target_acv,
                   monthly::DOUBLE AS current_month_target_acv,
                   {_ratio("total_ytd_closed_won_acv", "annual")} AS ytd_percent_to_annual_target,
                   {_ratio("total_qtd_closed_won_acv", "quarterly")} AS qtd_percent_to_quarter_target,
                   {_ratio("total_mtd_closed_won_acv", "monthly")} AS mtd_percent_to_month_target
            FROM (SELECT priority_level, {", ".join(f"SUM({a}) AS total_{a}" for a in ACTUALS)}
                  FROM cohort LEFT JOIN {step} USING (crm_account_id) GROUP BY priority_level), goal""",
    )


def _account_sums(until: str) -> str:
    """Sums per account; a to-date period's rows also meet ``until``, a condition on their date."""

    def of(condition: str) -> str:
        return f"SUM(CASE WHEN {condition} THEN acv ELSE 0 END)"

    def to_date(column: str, first: str) -> str:
        return f"{column} >= {first} AND {until.format(column)}"

    return f"""
        SELECT crm_account_id,
               {of("year(created) = year(first_day_of_prior_year)")} AS prior_year_pipeline_acv,
               {of("won AND year(closed) = year(first_day_of_prior_year)")} AS prior_year_closed_won_acv,
               {of(to_date("created", "first_day_of_current_year"))} AS ytd_pipeline_acv,
               {of("won AND " + to_date("closed", "first_day_of_current_year"))} AS ytd_closed_won_acv,
               {of(to_date("created", "first_day_of_current_quarter"))} AS qtd_pipeline_acv,
               {of("won AND " + to_date("closed", "first_day_of_current_quarter"))} AS qtd_closed_won_acv,
               {of(to_date("created", "first_day_of_current_month"))} AS mtd_pipeline_acv,
               {of("won AND " + to_date("closed", "first_day_of_current_month"))} AS mtd_closed_won_acv
        FROM deals GROUP BY crm_account_id"""


STEPS["account_sums"] = _account_sums("true")
STEPS["account_sums_bounded"] = _account_sums("{} <= as_of_date")

QUERIES: dict[str, Query | str] = {
    "r1_business_metrics": _growth("yoy"),
    "r1_from_state": _growth("yoy"),
    "r1_by_calendar": _growth("yoy_by_calendar"),
    "r2_partner_usage": Query(
        "totals hour_stats",
        """SELECT lower(strftime(m.week_start, '%B_%Y')) AS report_month, m.week_start AS report_week_start,
                  m.week_end AS report_week_end, 'cloud_hosted' AS deployment_type, m.model,
                  h.industry_vertical, h.billing_country, m.customer_uuid, m.calls AS total_call_volume,
                  m.input_tokens AS total_input_tokens, m.output_tokens AS total_output_tokens,
                  h.q[1] AS p20_hourly_call_volume, h.q[2] AS p50_hourly_call_volume,
                  h.q[3] AS p80_hourly_call_volume, h.peak AS peak_hourly_call_volume,
                  m.ttft AS avg_ttft_ms, m.duration AS avg_inference_time_ms
           FROM totals m LEFT JOIN hour_stats h
             ON m.week_start = h.week_start AND m.customer_uuid = h.customer_uuid AND m.model = h.model""",
    ),
    "r3_product_adoption": _adoption("adopted"),
    "r3_rollup_adoption": _adoption("adopted_or_all"),
    "r4_sales_performance": _attainment("account_sums"),
    "r4_bounded": _attainment("account_sums_bounded"),
    "s01_revenue_base": Query("base", "SELECT * REPLACE (acv::DOUBLE AS acv, mrr::DOUBLE AS mrr) FROM base"),
    "s02_group_metrics": _level("Product Group", "product_group"),
    "s03_name_metrics": _level("Product Name", "product_name"),
    "s04_category_metrics": _level("Product Category", "product_category"),
    "s05_hierarchy_grouping_sets": Query(
        "levels",
        """SELECT month_end_date, aggregation_level, aggregation_object, num_customers,
                  acv::DOUBLE AS total_acv, mrr::DOUBLE AS total_mrr FROM levels""",
    ),
    "s06_metrics_long_yoy": Query("yoy", f"SELECT {_YOY} FROM yoy"),
    "s07_eligible_dates": Query("buckets", "SELECT date, week_start AS first_day_of_week FROM buckets"),
    "s08_hourly_volume": Query(
        "hours",
        """SELECT week_start AS week_start_date, week_end AS week_end_date, customer_uuid, model,
                  industry_vertical, billing_country, hour_bucket, calls AS hourly_api_calls FROM hours""",
    ),
    "s09_usage_percentiles": Query(
        "hour_stats",
        """SELECT week_start AS week_start_date, customer_uuid, model, industry_vertical, billing_country,
                  q[1] AS p20_hourly_call_volume, q[2] AS p50_hourly_call_volume,
                  q[3] AS p80_hourly_call_volume, peak AS peak_hourly_call_volume FROM hour_stats""",
    ),
    "s10_usage_summary": Query(
        "totals",
        """SELECT week_start AS week_start_date, week_end AS week_end_date, customer_uuid, model,
                  input_tokens AS total_input_tokens, output_tokens AS total_output_tokens,
                  calls AS total_call_volume, ttft AS avg_ttft_ms, duration AS avg_inference_time_ms
           FROM totals""",
    ),
    "s11_report_date": "SELECT DISTINCT o_orderdate::DATE AS as_of, o_orderdate::DATE - 1 AS report_date FROM orders",
    "s12_active_entities": Query("active", "SELECT * FROM active"),
    "s13_feature_flags": Query(
        "flagged",
        """SELECT f.* FROM flagged f
           LEFT JOIN (SELECT user_id FROM settings WHERE is_js_challenge_enabled) s ON s.user_id = f.user_id""",
    ),
    "s14_adoption_long": Query("adopted", "SELECT * FROM adopted"),
    "s15_plan_totals": Query("plans", "SELECT * FROM plans"),
    "s16_cohort": Query("cohort", "SELECT * FROM cohort"),
    "s17_period_refs": Query(
        "order_days period", "SELECT * FROM period WHERE as_of_date IN (SELECT date FROM order_days)"
    ),
    "s18_opportunity_actuals": Query(
        "account_sums",
        f"SELECT crm_account_id, {', '.join(f'{a}::DOUBLE AS {a}' for a in ACTUALS)} FROM account_sums",
    ),
    "s19_vertical_targets": Query(
        "goal",
        """SELECT annual::DOUBLE AS total_annual_target_acv, quarterly::DOUBLE AS current_quarter_target_acv,
                  monthly::DOUBLE AS current_month_target_acv FROM goal""",
    ),
    "o_join_inner": Query(
        "logs buckets",
        """SELECT week_start AS first_day_of_week, COUNT(*) AS logged_calls, SUM(call_weight_from_sampling)::BIGINT AS calls
           FROM logs JOIN buckets ON event_date = date GROUP BY week_start""",
    ),
    "o_join_inner_extra_pred": Query(
        "users accounts",
        """SELECT u.user_id, a.account_id, a.organization_id FROM users u
           JOIN accounts a ON u.account_id = a.account_id AND a.is_active""",
    ),
    "o_join_left": Query(
        "logs accounts_dim",
        """SELECT industry_vertical, billing_country, SUM(call_weight_from_sampling)::BIGINT AS calls
           FROM logs LEFT JOIN accounts_dim USING (account_id) GROUP BY ALL""",
    ),
    "o_join_left_on_pred": Query(
        "users settings",
        """SELECT subscription_plan, s.is_js_challenge_enabled, COUNT(*) AS n_rows
           FROM users u LEFT JOIN settings s ON u.user_id = s.user_id AND s.is_js_challenge_enabled GROUP BY ALL""",
    ),
    "o_join_multi_key": Query(
        "logs",
        """SELECT a.*, b.slow_calls
           FROM (SELECT account_id, model_name, event_date, SUM(call_weight_from_sampling)::BIGINT AS calls
                 FROM logs GROUP BY ALL) a
           LEFT JOIN (SELECT account_id, model_name, event_date, SUM(call_weight_from_sampling)::BIGINT AS slow_calls
                      FROM logs WHERE time_to_first_token_ms > 50 GROUP BY ALL) b
             USING (account_id, model_name, event_date)""",
    ),
    "o_cross_join_scalar": """
        SELECT *, total_price / overall_price AS share
        FROM (SELECT o_orderstatus, SUM(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_price
              FROM orders GROUP BY o_orderstatus)
        CROSS JOIN (SELECT SUM(o_totalprice::DECIMAL(18,2))::DOUBLE AS overall_price FROM orders)""",
    "o_existence_flag": Query(
        "users analytics",
        """SELECT user_id, EXISTS (SELECT 1 FROM analytics a WHERE a.user_id = u.user_id AND is_proxied)
                  AS has_proxied_traffic FROM users u""",
    ),
    "o_group_by": """
        SELECT l_returnflag, l_linestatus, SUM(l_quantity::DECIMAL(18,2))::DOUBLE AS sum_qty,
               SUM(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_price
        FROM lineitem GROUP BY ALL""",
    "o_global_agg": """
        SELECT COUNT(*) AS n_rows, SUM(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_price,
               SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS returned_qty
        FROM lineitem""",
    "o_rollup_grouping": Query(
        "users",
        """SELECT CASE WHEN GROUPING(subscription_plan) = 1 THEN 'All' ELSE subscription_plan END AS plan,
                  GROUPING(subscription_plan)::INTEGER AS is_total, COUNT(*) AS n_users
           FROM users GROUP BY ROLLUP (subscription_plan)""",
    ),
    "o_count_distinct": """
        SELECT o_orderpriority, COUNT(*) AS n_customers
        FROM (SELECT DISTINCT o_orderpriority, o_custkey FROM orders) GROUP BY o_orderpriority""",
    "o_lag_spine": Query(
        "base",
        """SELECT m.product_name, m.month_end_date, now.acv::DOUBLE AS total_acv, ago.acv::DOUBLE AS total_acv_3_months_ago
           FROM (SELECT product_name, last_day(unnest(generate_series(date_trunc('month', min(month_end_date)), max(month_end_date), INTERVAL 1 MONTH))::DATE) AS month_end_date
                 FROM base GROUP BY product_name) AS m
           LEFT JOIN (SELECT product_name, month_end_date, SUM(acv) AS acv FROM base GROUP BY ALL) AS now
             ON now.product_name = m.product_name AND now.month_end_date = m.month_end_date
           LEFT JOIN (SELECT product_name, month_end_date, SUM(acv) AS acv FROM base GROUP BY ALL) AS ago
             ON ago.product_name = m.product_name AND ago.month_end_date = last_day(m.month_end_date - INTERVAL 3 MONTH)""",
    ),
    "o_distinct_levels": Query(
        "levels",
        """SELECT month_end_date, aggregation_level, aggregation_object, num_customers FROM levels
           WHERE aggregation_level IN ('Product Group', 'Product Category')""",
    ),
    "o_distinct_trailing": Query(
        "base",
        """SELECT months.month_end_date, level AS aggregation_level, object AS aggregation_object, COUNT(DISTINCT customer_id) AS num_customers
           FROM (SELECT month_end_date AS month, customer_id, unnest(['Product Group', 'Product Category']) AS level,
                        unnest([product_group, product_category]) AS object FROM base) AS members
           JOIN (SELECT last_day(m::DATE) AS month_end_date
                 FROM (SELECT unnest(generate_series(date_trunc('month', min(month_end_date)), max(month_end_date), INTERVAL 1 MONTH)) AS m FROM base)) AS months
             ON month <= months.month_end_date AND month > last_day(months.month_end_date - INTERVAL 12 MONTH)
           GROUP BY ALL""",
    ),
    "o_conditional_sum": """
        SELECT o_orderpriority,
               SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS finished_price,
               SUM(CASE WHEN o_orderstatus = 'O' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS open_price,
               SUM(CASE WHEN year(o_orderdate) >= 2001 THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE
                   AS price_since_2001
        FROM orders GROUP BY o_orderpriority""",
    "o_avg": """
        SELECT event_type, SUM(v::DECIMAL(18,2))::DOUBLE / NULLIF(COUNT(v), 0) AS avg_value
        FROM (SELECT event_type, CASE WHEN value > 50 THEN value END AS v FROM events) GROUP BY event_type""",
    "o_scaled_sum": """
        SELECT o_orderpriority, SUM(price * copies)::DECIMAL(38,9)::VARCHAR AS total_price
        FROM (SELECT o_orderpriority, (o_orderkey % 7 + 1)::DECIMAL(4,0) AS copies,
                     o_totalprice::DECIMAL(18,2)::DECIMAL(24,9) + (o_orderkey % 1000)::DECIMAL(9,0) * 0.000000001::DECIMAL(9,9) AS price
              FROM orders) GROUP BY o_orderpriority""",
    "o_exact_sum": """
        SELECT l_linestatus, l_returnflag,
               CASE WHEN l_returnflag = 'R' AND cents > 0 THEN '-' ELSE '' END || (cents // 100)::VARCHAR
                   || CASE WHEN cents // 100 > 0 THEN right('0' || (cents % 100)::VARCHAR, 2) || '0000000000000' ELSE '' END || '.00' AS total_price
        FROM (SELECT l_linestatus, l_returnflag,
                     SUM((l_extendedprice::DECIMAL(18,2) * 100)::HUGEINT * (l_orderkey % 1000 * 1000000000 + l_linenumber)::HUGEINT) AS cents
              FROM lineitem GROUP BY ALL)""",
    "s20_model_volumes": Query(
        "calls",
        """SELECT week_start AS first_day_of_week, model_name, n AS customer_hours, q[1] AS p20_hourly_call_volume,
                  q[2] AS p50_hourly_call_volume, q[3] AS p80_hourly_call_volume
           FROM (SELECT week_start, model_name, COUNT(*) AS n, quantile_disc(calls, [0.2, 0.5, 0.8]) AS q
                 FROM (SELECT week_start, model_name, account_id, date_trunc('hour', event_timestamp) AS h,
                              SUM(call_weight_from_sampling)::BIGINT AS calls FROM calls GROUP BY ALL) GROUP BY ALL)""",
    ),
    "o_approx_quantiles": Query(
        "logs",
        """SELECT model_name, event_date, q[1] AS p20, q[2] AS p50, q[3] AS p80
           FROM (SELECT model_name, event_date, quantile_disc(calls, [0.2, 0.5, 0.8]) AS q
                 FROM (SELECT model_name, event_date, hour(event_timestamp) AS h, SUM(call_weight_from_sampling)::BIGINT AS calls
                       FROM logs GROUP BY ALL) GROUP BY ALL)""",
    ),
    "o_bool_or": Query(
        "rules", "SELECT user_id, bool_or(uses_heuristic_rule) AS uses_heuristic_rule FROM rules GROUP BY user_id"
    ),
    "o_distinct_multi": "SELECT c_mktsegment, c_nationkey FROM customer GROUP BY ALL",
    "o_distinct_nested_field": Query(
        "interactions",
        """SELECT DISTINCT properties.user_id AS user_id FROM interactions
           WHERE properties.page_url LIKE '%/security/analytics'""",
    ),
    "o_lag_12": Query(
        "base",
        """SELECT *, LAG(total_acv, 12) OVER (PARTITION BY product_group ORDER BY month_end_date)
                  AS total_acv_prior_year
           FROM (SELECT product_group, month_end_date, SUM(acv)::DOUBLE AS total_acv FROM base GROUP BY ALL)""",
    ),
    "o_union_all_literal": f"""
        SELECT c_custkey, 'customer' AS list FROM customer
        UNION ALL
        SELECT c_custkey, 'building' FROM customer WHERE c_mktsegment = '{VERTICAL}'""",
    "o_scalar_subquery_filter": """
        SELECT event_id, event_type, ts::DATE AS event_date FROM events
        WHERE ts::DATE = (SELECT MAX(ts::DATE) FROM events)""",
    "o_scalar_subquery_project": """
        SELECT (SELECT MAX(o_orderdate)::DATE FROM orders) AS report_date, c_mktsegment, COUNT(*) AS n_customers
        FROM customer GROUP BY c_mktsegment""",
    "o_between_dates": """
        SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE year(o_orderdate) = 2000""",
    "o_like_prefix_or": f"""
        SELECT p_partkey, p_name FROM part
        WHERE (starts_with(p_name, 'small') OR starts_with(p_name, 'red')) AND p_type = '{CATEGORY}'""",
    "o_like_suffix": "SELECT p_partkey, p_name FROM part WHERE suffix(p_name, 'ring')",
    "o_in_list": """
        SELECT o_orderkey, o_orderpriority FROM orders
        WHERE o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH' OR o_orderpriority = '3-MEDIUM'""",
    "o_null_handling": Query(
        "rules",
        """SELECT user_id, uses_heuristic_rule IS NOT NULL AS is_known,
                  COALESCE(uses_heuristic_rule, false) AS or_false,
                  CASE WHEN uses_heuristic_rule THEN 1 ELSE 0 END AS as_number,
                  COALESCE(uses_heuristic_rule::VARCHAR, user_id::VARCHAR) AS flag_or_user
           FROM rules""",
    ),
    "o_safe_divide": """
        SELECT event_id, value::DECIMAL(18,2)::DOUBLE / NULLIF((event_id % 3)::DOUBLE, 0) AS ratio,
               event_id::DOUBLE / NULLIF(NULLIF(event_id % 3, 1)::DOUBLE, 0) AS ratio_of_null
        FROM events""",
    "o_date_arith": """
        SELECT o_orderkey, d - 1 AS day_before, d + 6 AS six_days_on,
               (d - INTERVAL 1 MONTH)::DATE AS month_before, (d - INTERVAL 1 YEAR)::DATE AS year_before,
               make_date(year(d) - 1, 12, 31) AS end_of_year_before
        FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""",
    "o_date_parts": """
        SELECT o_orderkey, date_trunc('month', d)::DATE AS month_start, date_trunc('year', d)::DATE AS year_start,
               last_day(d) AS month_end, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter
        FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""",
    "o_hour_bucket": "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS hour_bucket FROM events",
    "o_month_week_bucket": """
        SELECT o_orderkey, s AS week_start,
               CASE WHEN month(s + 6) = month(s) THEN s + 6 ELSE last_day(s) END AS week_end
        FROM (SELECT o_orderkey, make_date(year(d), month(d), ((day(d) - 1) // 7 * 7 + 1)::INTEGER) AS s
              FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders))""",
    "o_least_clip": """
        SELECT o_orderkey, CASE WHEN month(d + 6) = month(d) THEN d + 6 ELSE last_day(d) END AS clipped,
               CASE WHEN o_orderstatus = 'F'
                    THEN CASE WHEN month(d + 3) = month(d) THEN d + 3 ELSE last_day(d) END END AS shipped_in_month
        FROM (SELECT o_orderkey, o_orderstatus, o_orderdate::DATE AS d FROM orders)""",
    "o_format_month_label": "SELECT o_orderkey, lower(strftime(o_orderdate, '%B_%Y')) AS label FROM orders",
    "o_pseudonym_key": Query(
        "logs",
        f"""SELECT event_timestamp, account_id,
                   CASE WHEN account_id IS NOT NULL THEN sha256('{SALT}' || account_id::VARCHAR) END AS customer_uuid
            FROM logs""",
    ),
}


def oracle_sql(fixtures: Mapping[str, str] = FIXTURES) -> dict[str, str]:
    """Each query's SQL, over the test tables or over other definitions of the source tables."""
    return {name: q.sql(fixtures) if isinstance(q, Query) else q.strip() for name, q in QUERIES.items()}
