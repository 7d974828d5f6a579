"""Every query over the test tables: the reports (r), their stages (s) and single operators (o)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizmetrics.functions import (
    hour_bucket,
    least_strict,
    month_label,
    month_week_end,
    month_week_start,
    months_before,
    pseudonym_key,
    safe_divide,
    scaled,
    years_before,
)
from bizmetrics.operators import (
    approx_percentiles,
    attach_row,
    dense_numbers,
    hourly_usage,
    join_member_counts,
    levels_of,
    limb_sums,
    limbs_text,
    member_sets,
    membership_flags,
    month_spine,
    period_row,
    period_sums,
    prior_period,
    report_date,
    row_value,
    set_sizes,
    trailing_months,
    with_bucket_end,
)
from bizmetrics.plans import feature_adoption as adoption
from bizmetrics.plans import hierarchy_growth as growth
from bizmetrics.plans import model_usage as usage
from bizmetrics.plans import sales_attainment as sales
from bizmetrics.sinks import scratch_folder
from bizmetrics.sources.testdata import (
    ADOPTION_AS_OF,
    CATEGORY,
    SALES_AS_OF,
    SALT,
    USAGE_AS_OF,
    VERTICAL,
    TestTables,
    money,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    """Sums are exact decimals; as doubles they compare alike in every engine."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )


def query(build: Callable[[TestTables], DataFrame]) -> Callable[[TestTables], DataFrame]:
    """Register a function of the test tables under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_as_doubles(build(TestTables(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# --- reports -------------------------------------------------------------------------------


@query
def r1_business_metrics(t: TestTables) -> DataFrame:
    return growth.hierarchy_growth(t.sources(), CATEGORY)


@query
def r2_partner_usage(t: TestTables) -> DataFrame:
    return usage.model_usage(t.sources(), SALT, USAGE_AS_OF)


@query
def r3_product_adoption(t: TestTables) -> DataFrame:
    return adoption.feature_adoption(t.sources(), ADOPTION_AS_OF)


@query
def r4_sales_performance(t: TestTables) -> DataFrame:
    return sales.sales_attainment(t.sources(), SALES_AS_OF, VERTICAL)


@query
def r1_by_calendar(t: TestTables) -> DataFrame:
    """Compared with the same month of the year before, if that has data."""
    return growth.hierarchy_growth(t.sources(), CATEGORY, by_calendar=True)


@query
def r1_from_state(t: TestTables) -> DataFrame:
    """From metrics kept per month: made of the years up to 1997 and half of the later revenue, and brought up to date when the rest is there."""
    folder, hierarchy = scratch_folder(t.spark), t.sources()["hierarchy"]
    early = (F.year("month_end_date") <= 1997) | (F.col("customer_id") % 2 == 0)
    for rows in (early, ~early):
        revenue = t.revenue().where(rows).hint("rebalance", "month_end_date")
        revenue.write.partitionBy("month_end_date").mode("append").parquet(f"{folder}/revenue")
        state = growth.metrics_state(t.spark, f"{folder}/state", f"{folder}/revenue", hierarchy, CATEGORY)
        report = growth.growth_from_state(state)
    return report


@query
def r3_rollup_adoption(t: TestTables) -> DataFrame:
    """With adoption over all plans in the total's rows."""
    return adoption.feature_adoption(t.sources(), ADOPTION_AS_OF, rollup_adoption=True)


@query
def r4_bounded(t: TestTables) -> DataFrame:
    """With to-date periods that end on the report date."""
    return sales.sales_attainment(t.sources(), SALES_AS_OF, VERTICAL, bounded=True)


# --- stages --------------------------------------------------------------------------------


@query
def s01_revenue_base(t: TestTables) -> DataFrame:
    return growth.revenue_base(t.sources(), CATEGORY)


def _one_level(t: TestTables, label: str) -> DataFrame:
    column = growth.LEVELS[label]
    metrics = growth.level_metrics(growth.revenue_base(t.sources(), CATEGORY), {label: column})
    return metrics.drop("aggregation_level").withColumnRenamed("aggregation_object", column)


@query
def s02_group_metrics(t: TestTables) -> DataFrame:
    return _one_level(t, "Product Group")


@query
def s03_name_metrics(t: TestTables) -> DataFrame:
    return _one_level(t, "Product Name")


@query
def s04_category_metrics(t: TestTables) -> DataFrame:
    return _one_level(t, "Product Category")


@query
def s05_hierarchy_grouping_sets(t: TestTables) -> DataFrame:
    return growth.level_metrics(growth.revenue_base(t.sources(), CATEGORY))


@query
def s06_metrics_long_yoy(t: TestTables) -> DataFrame:
    return growth.with_prior_year(s05_hierarchy_grouping_sets(t))


@query
def s07_eligible_dates(t: TestTables) -> DataFrame:
    return usage.eligible_dates(t.event_calendar(), USAGE_AS_OF)


@query
def s08_hourly_volume(t: TestTables) -> DataFrame:
    sources = t.sources()
    return usage.hourly_volume(usage.calls_by_hour(sources, USAGE_AS_OF), sources["accounts_dim"], SALT)


@query
def s09_usage_percentiles(t: TestTables) -> DataFrame:
    sources = t.sources()
    return usage.volume_percentiles(usage.calls_by_hour(sources, USAGE_AS_OF), sources["accounts_dim"], SALT)


@query
def s10_usage_summary(t: TestTables) -> DataFrame:
    return usage.usage_summary(usage.calls_by_hour(t.sources(), USAGE_AS_OF), SALT)


@query
def s11_report_date(t: TestTables) -> DataFrame:
    """For each day with orders, the report date when the report runs on that day."""
    days = t.read("orders").select(F.col("o_orderdate").cast("date").alias("as_of")).distinct()
    return days.select("as_of", report_date(F.col("as_of")).alias("report_date"))


@query
def s12_active_entities(t: TestTables) -> DataFrame:
    return adoption.active_entities(t.sources())


@query
def s13_feature_flags(t: TestTables) -> DataFrame:
    return adoption.user_flags_per_setting(t.sources(), ADOPTION_AS_OF)


@query
def s14_adoption_long(t: TestTables) -> DataFrame:
    return adoption.adoption_long(adoption.user_flags(t.sources(), ADOPTION_AS_OF))


@query
def s15_plan_totals(t: TestTables) -> DataFrame:
    return adoption.plan_totals(adoption.active_entities(t.sources()))


@query
def s16_cohort(t: TestTables) -> DataFrame:
    return sales.account_cohort(t.sources(), SALES_AS_OF, VERTICAL)


@query
def s17_period_refs(t: TestTables) -> DataFrame:
    return period_row(t.order_calendar(), SALES_AS_OF)


@query
def s18_opportunity_actuals(t: TestTables) -> DataFrame:
    sources = t.sources()
    return sales.opportunity_actuals(sources["opportunity"], period_row(sources["calendar"], SALES_AS_OF))


@query
def s19_vertical_targets(t: TestTables) -> DataFrame:
    sources = t.sources()
    refs = period_row(sources["calendar"], SALES_AS_OF)
    return sales.vertical_targets(sources["targets"], refs, SALES_AS_OF, VERTICAL)


@query
def s20_model_volumes(t: TestTables) -> DataFrame:
    """Percentiles per week and model from sketches per hour, kept day by day: half of the days' logs first, then the others and more rows for some."""
    folder, logs = scratch_folder(t.spark), t.logs()
    early = (F.dayofmonth("event_date") <= 15) & (F.col("input_tokens") % 7 != 0)
    for rows in (early, ~early):
        logs.where(rows).hint("rebalance", "event_date").write.partitionBy("event_date").mode("append").parquet(f"{folder}/logs")
        state = usage.volume_sketches(t.spark, f"{folder}/state", f"{folder}/logs")
        state.refresh()
    return usage.model_volumes(state.rows(), usage.eligible_dates(t.event_calendar(), USAGE_AS_OF))


# --- joins ---------------------------------------------------------------------------------


@query
def o_join_inner(t: TestTables) -> DataFrame:
    """Calls on eligible days, counted per 7-day bucket. They are summed per day before they meet the calendar."""
    days = usage.eligible_dates(t.event_calendar(), USAGE_AS_OF)
    per_day = (
        t.logs()
        .groupBy("event_date")
        .agg(F.count("*").alias("logged_calls"), F.sum("call_weight_from_sampling").alias("calls"))
    )
    return (
        per_day.join(days, per_day["event_date"] == days["date"])
        .groupBy("first_day_of_week")
        .agg(F.sum("logged_calls").alias("logged_calls"), F.sum("calls").alias("calls"))
    )


@query
def o_join_inner_extra_pred(t: TestTables) -> DataFrame:
    """Users of active accounts, whether or not the user is active."""
    active = t.accounts().where("is_active").select("account_id", "organization_id")
    return t.users().join(active, "account_id").select("user_id", "account_id", "organization_id")


@query
def o_join_left(t: TestTables) -> DataFrame:
    """Calls per segment; accounts without a dimension row, or without an id, have a NULL segment."""
    per_account = t.logs().groupBy("account_id").agg(F.sum("call_weight_from_sampling").alias("calls"))
    return (
        per_account.join(t.accounts_dim(), "account_id", "left")
        .groupBy("industry_vertical", "billing_country")
        .agg(F.sum("calls").alias("calls"))
    )


@query
def o_join_left_on_pred(t: TestTables) -> DataFrame:
    """Users left-joined to their enabled settings, as joined rows per plan and flag.

    The settings are counted per user first, so a user with very many of them is one row.
    """
    enabled = t.settings().where("is_js_challenge_enabled")
    joined = join_member_counts(t.users(), {"n_settings": enabled}, "user_id")
    flag = F.when(F.col("n_settings") > 0, True)
    return joined.groupBy("subscription_plan", flag.alias("is_js_challenge_enabled")).agg(
        F.sum(F.greatest("n_settings", F.lit(1))).alias("n_rows")
    )


@query
def o_join_multi_key(t: TestTables) -> DataFrame:
    """Daily calls per model left-joined to error-free calls on (account, model, day); NULL accounts don't match."""
    keys = ["account_id", "model_name", "event_date"]
    calls = F.sum("call_weight_from_sampling")
    logs = t.logs()
    all_calls = logs.groupBy(*keys).agg(calls.alias("calls"))
    slow = logs.where(F.col("time_to_first_token_ms") > 50).groupBy(*keys).agg(calls.alias("slow_calls"))
    return all_calls.join(slow, keys, "left")


@query
def o_cross_join_scalar(t: TestTables) -> DataFrame:
    """Order value per status next to the value of all orders."""
    orders = t.read("orders").select("o_orderstatus", money("o_totalprice").alias("price"))
    overall = orders.agg(F.sum("price").alias("overall_price"))
    per_status = orders.groupBy("o_orderstatus").agg(F.sum("price").alias("total_price"))
    return attach_row(per_status, overall).withColumn(
        "share", safe_divide(F.col("total_price"), F.col("overall_price"))
    )


@query
def o_existence_flag(t: TestTables) -> DataFrame:
    """Every user, with a flag for proxied traffic on any day."""
    proxied = t.analytics().where("is_proxied")
    return membership_flags(t.users().select("user_id"), {"has_proxied_traffic": proxied}, "user_id")


# --- aggregations --------------------------------------------------------------------------


@query
def o_group_by(t: TestTables) -> DataFrame:
    return (
        t.read("lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.sum(money("l_quantity")).alias("sum_qty"), F.sum(money("l_extendedprice")).alias("sum_price"))
    )


@query
def o_global_agg(t: TestTables) -> DataFrame:
    return t.read("lineitem").agg(
        F.count("*").alias("n_rows"),
        F.sum(money("l_extendedprice")).alias("sum_price"),
        F.sum(F.when(F.col("l_returnflag") == "R", money("l_quantity")).otherwise(0)).alias("returned_qty"),
    )


@query
def o_rollup_grouping(t: TestTables) -> DataFrame:
    """Users per plan and over all plans; the NULL plan is not the total, and the total is there without users too."""
    return users_per_plan(t.users())


def users_per_plan(users: DataFrame) -> DataFrame:
    label = F.when(F.grouping("subscription_plan") == 1, "All").otherwise(F.col("subscription_plan"))
    rolled = users.rollup("subscription_plan").agg(
        label.alias("plan"),
        F.grouping("subscription_plan").cast("int").alias("is_total"),
        F.count("*").alias("n_users"),
    )
    nobody = users.sparkSession.range(1).select(F.lit("All").alias("plan"), F.lit(1).alias("is_total"), F.lit(0).cast("bigint").alias("n_users"))
    return rolled.drop("subscription_plan").unionByName(nobody).groupBy("plan", "is_total").agg(F.sum("n_users").alias("n_users"))


@query
def o_count_distinct(t: TestTables) -> DataFrame:
    return t.read("orders").groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("n_customers"))


def _monthly_customers(t: TestTables) -> DataFrame:
    """The set of customers per month, product group and category, kept in the scratch folder."""
    folder, base = scratch_folder(t.spark), growth.revenue_base(t.sources(), CATEGORY)
    numbers = dense_numbers(base, "customer_id", f"{folder}/keys")
    numbers.write.parquet(f"{folder}/numbers")
    numbered = base.join(t.spark.read.parquet(f"{folder}/numbers"), "customer_id", "left")
    member_sets(numbered, ["month_end_date", "product_group", "product_category"]).write.parquet(f"{folder}/sets")
    return t.spark.read.parquet(f"{folder}/sets")


_SET_LEVELS = {label: growth.LEVELS[label] for label in ("Product Group", "Product Category")}


@query
def o_distinct_levels(t: TestTables) -> DataFrame:
    """Customers per month of groups and categories, the latter as unions of the groups' sets."""
    sets = levels_of(_monthly_customers(t), ["month_end_date"], _SET_LEVELS)
    return set_sizes(sets, ["month_end_date", "aggregation_level", "aggregation_object"], "num_customers")


@query
def o_distinct_trailing(t: TestTables) -> DataFrame:
    """Customers of the twelve months up to each month, as unions of the months' sets: the fact is not read again for a window."""
    monthly = _monthly_customers(t)
    last = monthly.agg(F.max("month_end_date").alias("last"))
    sets = levels_of(trailing_months(monthly, "month_end_date", 12, row_value(last)["last"]), ["month_end_date"], _SET_LEVELS)
    return set_sizes(sets, ["month_end_date", "aggregation_level", "aggregation_object"], "num_customers")


@query
def o_conditional_sum(t: TestTables) -> DataFrame:
    """Order value per priority, by status and for 2001."""
    orders = t.read("orders").withColumn("price", money("o_totalprice"))
    conditions = {
        "finished_price": F.col("o_orderstatus") == "F",
        "open_price": F.col("o_orderstatus") == "O",
        "price_since_2001": F.col("o_orderdate").cast("date") >= F.lit("2001-01-01").cast("date"),
    }
    return period_sums(orders, ["o_orderpriority"], "price", conditions)


@query
def o_scaled_sum(t: TestTables) -> DataFrame:
    """Amounts of nine decimal places, each counted several times, summed to the last digit; as text, to be compared so."""
    price = money("o_totalprice").cast("decimal(24,9)") + (F.col("o_orderkey") % 1000).cast("decimal(9,0)") * F.lit("0.000000001").cast("decimal(9,9)")
    orders = t.read("orders").select("o_orderpriority", price.cast("decimal(38,9)").alias("price"), (F.col("o_orderkey") % 7 + 1).alias("copies"))
    total = F.sum(scaled(F.col("price"), F.col("copies"), orders.schema["price"].dataType))
    return orders.groupBy("o_orderpriority").agg(total.cast("string").alias("total_price"))


@query
def o_exact_sum(t: TestTables) -> DataFrame:
    """Amounts of 28 digits, returned ones negative, each counted up to 10^12 times: sums of over 38 digits, as text."""
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")
    price = (money("l_extendedprice") * sign).cast("decimal(38,2)") * F.lit("1000000000000000").cast("decimal(16,0)")
    lines = t.read("lineitem").select("l_linestatus", "l_returnflag", price.cast("decimal(38,2)").alias("price"), (F.col("l_orderkey") % 1000 * 1000000000 + F.col("l_linenumber")).alias("copies"))
    sums = lines.groupBy("l_linestatus", "l_returnflag").agg(limb_sums(F.col("price"), F.col("copies"), lines.schema["price"].dataType).alias("limbs"))
    return sums.select("l_linestatus", "l_returnflag", limbs_text(F.col("limbs"), lines.schema["price"].dataType).alias("total_price"))


@query
def o_avg(t: TestTables) -> DataFrame:
    """Average value per event type, over values above 50 only: the others are NULL and not counted."""
    value = F.when(F.col("value") > 50, money("value"))
    mean = F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))
    return t.read("events").groupBy("event_type").agg(mean.alias("avg_value"))


@query
def o_approx_quantiles(t: TestTables) -> DataFrame:
    """Percentiles of a day's hourly volumes per model."""
    hours = hourly_usage(
        t.logs(),
        ["model_name", "event_date"],
        F.col("event_timestamp"),
        {"calls": "call_weight_from_sampling"},
        [],
    )
    points = {"p20": 20, "p50": 50, "p80": 80}
    return hours.groupBy("model_name", "event_date").agg(*approx_percentiles("calls", points))


@query
def o_bool_or(t: TestTables) -> DataFrame:
    return t.rules().groupBy("user_id").agg(F.bool_or("uses_heuristic_rule").alias("uses_heuristic_rule"))


@query
def o_distinct_multi(t: TestTables) -> DataFrame:
    return t.read("customer").select("c_mktsegment", "c_nationkey").distinct()


@query
def o_distinct_nested_field(t: TestTables) -> DataFrame:
    """Users who opened the analytics page, read from a struct; the column takes the field's name."""
    opened = t.interactions().where(F.col("properties.page_url").endswith(adoption.DASHBOARD_PAGE))
    return opened.select("properties.user_id").distinct()


# --- window, union, subqueries, predicates -------------------------------------------------


@query
def o_lag_spine(t: TestTables) -> DataFrame:
    """Monthly revenue per product and three months earlier, with a row for every month between a product's first and last."""
    monthly = (
        growth.revenue_base(t.sources(), CATEGORY)
        .groupBy("product_name", "month_end_date")
        .agg(F.sum("acv").alias("total_acv"))
    )
    spine = month_spine(monthly, ["product_name"], "month_end_date")
    return prior_period(spine, ["product_name"], "month_end_date", ["total_acv"], periods=3, suffix="_3_months_ago")


@query
def o_lag_12(t: TestTables) -> DataFrame:
    """Monthly revenue per product group and 12 rows earlier."""
    monthly = (
        growth.revenue_base(t.sources(), CATEGORY)
        .groupBy("product_group", "month_end_date")
        .agg(F.sum("acv").alias("total_acv"))
    )
    return prior_period(monthly, ["product_group"], "month_end_date", ["total_acv"])


@query
def o_union_all_literal(t: TestTables) -> DataFrame:
    """Every customer, and those of one segment again, each with the name of its list."""
    customers = t.read("customer")
    everyone = customers.select("c_custkey", F.lit("customer").alias("list"))
    building = customers.where(F.col("c_mktsegment") == VERTICAL).select("c_custkey", F.lit("building"))
    return everyone.union(building)


@query
def o_scalar_subquery_filter(t: TestTables) -> DataFrame:
    """Events of the last day that has any."""
    events = t.read("events").select("event_id", "event_type", F.col("ts").cast("date").alias("event_date"))
    last_day = events.agg(F.max("event_date").alias("last_day")).scalar()
    return events.where(F.col("event_date") == last_day)


@query
def o_scalar_subquery_project(t: TestTables) -> DataFrame:
    """Customers per segment, each row with the date of the last order."""
    last_order = t.read("orders").agg(F.max(F.col("o_orderdate").cast("date")).alias("day"))
    per_segment = t.read("customer").groupBy("c_mktsegment").agg(F.count("*").alias("n_customers"))
    return per_segment.select(row_value(last_order)["day"].alias("report_date"), "*")


@query
def o_between_dates(t: TestTables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.read("orders").where(day.between("2000-01-01", "2000-12-31")).select("o_orderkey", day.alias("day"))


@query
def o_like_prefix_or(t: TestTables) -> DataFrame:
    parts = t.read("part")
    name = F.col("p_name")
    chosen = (name.like("small%") | name.like("red%")) & (F.col("p_type") == CATEGORY)
    return parts.where(chosen).select("p_partkey", "p_name")


@query
def o_like_suffix(t: TestTables) -> DataFrame:
    return t.read("part").where(F.col("p_name").like("%ring")).select("p_partkey", "p_name")


@query
def o_in_list(t: TestTables) -> DataFrame:
    chosen = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    return t.read("orders").where(chosen).select("o_orderkey", "o_orderpriority")


@query
def o_null_handling(t: TestTables) -> DataFrame:
    """IS NOT NULL, COALESCE, IFNULL and IF over a flag that may be NULL."""
    flag = F.col("uses_heuristic_rule")
    return t.rules().select(
        "user_id",
        flag.isNotNull().alias("is_known"),
        F.ifnull(flag, F.lit(False)).alias("or_false"),
        F.when(flag, 1).otherwise(0).alias("as_number"),
        F.coalesce(flag.cast("string"), F.col("user_id").cast("string")).alias("flag_or_user"),
    )


# --- scalar functions ----------------------------------------------------------------------


@query
def o_safe_divide(t: TestTables) -> DataFrame:
    remainder = F.col("event_id") % 3
    return t.read("events").select(
        "event_id",
        safe_divide(money("value"), remainder).alias("ratio"),
        safe_divide(F.col("event_id"), F.nullif(remainder, F.lit(1))).alias("ratio_of_null"),
    )


@query
def o_date_arith(t: TestTables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.read("orders").select(
        "o_orderkey",
        F.date_sub(day, 1).alias("day_before"),
        F.date_add(day, 6).alias("six_days_on"),
        months_before(day, 1).alias("month_before"),
        years_before(day, 1).alias("year_before"),
        F.date_sub(F.add_months(F.trunc(years_before(day, 1), "year"), 12), 1).alias("end_of_year_before"),
    )


@query
def o_date_parts(t: TestTables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return t.read("orders").select(
        "o_orderkey",
        F.trunc(day, "month").alias("month_start"),
        F.trunc(day, "year").alias("year_start"),
        F.last_day(day).alias("month_end"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
    )


@query
def o_hour_bucket(t: TestTables) -> DataFrame:
    return t.read("events").select("event_id", hour_bucket(F.col("ts")).alias("hour_bucket"))


@query
def o_month_week_bucket(t: TestTables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    started = t.read("orders").select(
        "o_orderkey", month_week_start(day, F.trunc(day, "month")).alias("week_start")
    )
    return with_bucket_end(started, "week_start", "week_end")


@query
def o_least_clip(t: TestTables) -> DataFrame:
    """A week from the order date clipped to its month, and a strict minimum with a side that may be NULL."""
    day = F.col("o_orderdate").cast("date")
    shipped = F.when(F.col("o_orderstatus") == "F", F.date_add(day, 3))
    return t.read("orders").select(
        "o_orderkey",
        month_week_end(day).alias("clipped"),
        least_strict(shipped, F.last_day(day)).alias("shipped_in_month"),
    )


@query
def o_format_month_label(t: TestTables) -> DataFrame:
    return t.read("orders").select("o_orderkey", month_label(F.col("o_orderdate").cast("date")).alias("label"))


@query
def o_pseudonym_key(t: TestTables) -> DataFrame:
    key = pseudonym_key(F.col("account_id"), SALT)
    return t.logs().select("event_timestamp", "account_id", key.alias("customer_uuid"))
