"""What the physical plans look like: one read per fact, pruned and pushed-down scans, no Python, no cross joins."""

import re

import pytest
from builders import table
from pyspark.sql import functions as F

from bizmetrics.operators import membership_flags, repeat_rows
from bizmetrics.plans import feature_adoption as adoption
from bizmetrics.plans import hierarchy_growth as growth
from bizmetrics.plans import model_usage as usage
from bizmetrics.queries import QUERIES
from bizmetrics.sources import Sources, calendar


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as it was run, without the initial plan that AQE started from."""
    df.collect()
    return physical(df).split("== Initial Plan ==")[0]


def scans(plan: str, table_name: str) -> list[str]:
    return [line for line in plan.splitlines() if "FileScan" in line and f"{table_name}.parquet" in line]


@pytest.fixture
def without_broadcast(spark):
    """No broadcasts, and thresholds at which the small test tables count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_no_cross_join_and_no_hint(spark, small_dir, name):
    execution = QUERIES[name](spark, small_dir)._jdf.queryExecution()
    assert "ResolvedHint" not in execution.analyzed().toString()
    assert not re.search("Python|Pandas|CartesianProduct|NestedLoop", execution.executedPlan().toString())


@pytest.mark.parametrize("name", list(QUERIES))
def test_exchanges_carry_partial_aggregates(spark, small_dir, name):
    """No rows are gathered by a single task, but for the partial rows of a global aggregate."""
    plan = physical(QUERIES[name](spark, small_dir))
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:], strict=False):
        if "Exchange SinglePartition" in line:
            assert "partial_" in below


def test_revenue_is_read_once_for_all_levels(spark, small_dir):
    plan = physical(QUERIES["r1_business_metrics"](spark, small_dir))
    assert len(scans(plan, "lineitem")) == len(scans(plan, "orders")) == len(scans(plan, "part")) == 1
    assert "LeftOuter" not in plan
    (scan,) = scans(plan, "part")
    assert "EqualTo(p_type,PROMO)" in scan
    (scan,) = scans(plan, "lineitem")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in scan


def test_the_log_is_read_once(spark, small_dir):
    plan = physical(QUERIES["r2_partner_usage"](spark, small_dir))
    assert len(scans(plan, "events")) == 1
    assert len(scans(plan, "customer")) == 1


def test_opportunities_are_read_once(spark, small_dir):
    plan = physical(QUERIES["s18_opportunity_actuals"](spark, small_dir))
    assert len(scans(plan, "orders")) == 1


def test_each_feature_source_is_read_once(spark, small_dir):
    plan = physical(QUERIES["r3_product_adoption"](spark, small_dir))
    assert len(scans(plan, "events")) == 3  # rules, analytics and interactions are all derived from events
    assert len(scans(plan, "orders")) == len(scans(plan, "customer")) == len(scans(plan, "supplier")) == 1


def write_partitioned_logs(spark, path):
    days = spark.range(90).select(F.date_add(F.lit("2023-12-01").cast("date"), F.col("id").cast("int")).alias("event_date"))
    logs = days.select(
        F.lit(1).cast("bigint").alias("account_id"),
        F.lit("partner-a/model-family-x-1").alias("model_name"),
        F.col("event_date").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit(0).alias("error_code"),
        *[F.lit(1).cast("bigint").alias(c) for c in ("call_weight_from_sampling", "input_tokens", "output_tokens")],
        *[F.lit(1.5).alias(c) for c in ("time_to_first_token_ms", "inference_duration_ms")],
        F.lit("not read").alias("payload"),
        "event_date",
    )
    logs.coalesce(1).write.partitionBy("event_date").parquet(path)


def test_the_month_prunes_log_partitions_and_filters_are_pushed(spark, tmp_path):
    write_partitioned_logs(spark, str(tmp_path / "logs"))
    calendar(spark, "2023-01-01", "2024-12-31").write.parquet(str(tmp_path / "calendar"))
    table(spark, "accounts_dim", [(1, "V", "C")]).write.parquet(str(tmp_path / "accounts"))
    src = Sources.from_parquet(
        spark,
        logs=str(tmp_path / "logs"),
        calendar=str(tmp_path / "calendar"),
        accounts_dim=str(tmp_path / "accounts"),
    )
    plan = final_plan(usage.model_usage(src, "salt", "2024-02-15"))
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line and "model_name" in line]
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
    assert "event_date#" in partition_filters
    assert ">= 2024-01-01" in partition_filters and "<= 2024-01-31" in partition_filters
    assert "EqualTo(error_code,0)" in scan
    assert "StringStartsWith(model_name,partner-a/model-family-x-)" in scan
    assert "payload" not in scan


def test_dashboard_views_prune_days_and_nested_fields(spark, tmp_path):
    rows = spark.range(20).select(
        F.date_add(F.lit("2024-01-15").cast("date"), F.col("id").cast("int")).alias("event_date"),
        F.struct(
            F.col("id").alias("user_id"),
            F.lit("/security/analytics").alias("page_url"),
            F.lit("not read").alias("browser"),
        ).alias("properties"),
    )
    rows.coalesce(1).write.partitionBy("event_date").parquet(str(tmp_path / "views"))
    views = Sources.from_parquet(spark, interactions=str(tmp_path / "views"))
    none = {n: table(spark, n, []) for n in ("rules", "analytics", "settings")}
    views = adoption.adopters({**none, "interactions": views["interactions"]}, "2024-01-31")[adoption.DASHBOARD]
    plan = physical(views)
    assert "event_date#" in plan and ">= 2024-01-23" in plan and "<= 2024-01-30" in plan
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date", plan)
    assert "StringEndsWith(properties.page_url,/security/analytics)" in plan
    assert "ReadSchema: struct<properties:struct<user_id:bigint,page_url:string>>" in plan
    assert views.count() == 8


def test_a_report_for_today_prunes_partitions_too(spark, tmp_path):
    rows = spark.range(10).select(
        F.date_sub(F.current_date(), F.col("id").cast("int")).alias("event_date"),
        F.col("id").alias("user_id"),
        F.lit(True).alias("is_proxied"),
    )
    rows.coalesce(1).write.partitionBy("event_date").parquet(str(tmp_path / "analytics"))
    src = {n: table(spark, n, []) for n in ("rules", "settings", "interactions")}
    src["analytics"] = Sources.from_parquet(spark, analytics=str(tmp_path / "analytics"))["analytics"]
    proxied = adoption.adopters(src)[adoption.PROXY]
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date#\d+\), \(event_date#\d+ = \d{4}-", physical(proxied))
    assert [r["user_id"] for r in proxied.collect()] == [1]


def test_a_product_with_a_third_of_the_revenue_is_split(spark, without_broadcast):
    revenue = spark.range(200_000).select(
        F.last_day(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 600).cast("int"))).alias("month_end_date"),
        (F.xxhash64("id") % 5000).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("product_id"),
        (F.col("id") % 99).cast("decimal(18,2)").alias("acv"),
        F.lit(1).cast("decimal(18,2)").alias("mrr"),
    )
    products = spark.range(1000).select(
        F.col("id").alias("product_id"),
        F.lit("Analytics").alias("product_category"),
        F.lit("G").alias("product_group"),
        F.concat(F.lit("N"), F.col("id") % 7).alias("product_name"),
    )
    report = growth.hierarchy_growth({"revenue": revenue, "hierarchy": products})
    assert "SortMergeJoin(skew=true)" in final_plan(report)


def test_an_account_with_a_third_of_the_users_is_split(spark, without_broadcast):
    users = spark.range(100_000).select(
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("account_id"),
        F.concat(F.lit("plan"), F.col("id") % 5).alias("subscription_plan"),
        F.lit(True).alias("is_active"),
    )
    accounts = spark.range(500).select(
        F.col("id").alias("account_id"), (F.col("id") % 30).cast("int").alias("organization_id"), F.lit(True).alias("is_active")
    )
    src = {n: table(spark, n, []) for n in ("orgs", "rules", "analytics", "settings", "interactions")}
    src |= {"users": users, "accounts": accounts}
    assert "SortMergeJoin(skew=true)" in final_plan(adoption.feature_adoption(src, "2024-01-31"))


def test_a_user_in_a_third_of_the_rows_is_split(spark, without_broadcast):
    users = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("user_id"),
        (F.col("id") % 500).alias("account_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("subscription_plan"),
    )
    seen = spark.range(100_000).select((F.col("id") % 50_000).alias("user_id"))
    flagged = membership_flags(users, {"seen": seen}, "user_id")
    assert "SortMergeJoin(skew=true)" in final_plan(flagged)
    assert flagged.where("seen").count() == users.where("user_id < 50000").count()
    assert flagged.count() == 100_000


def test_a_row_repeated_very_often_is_spread_over_tasks(spark):
    df = spark.createDataFrame([(1, 100_000), (2, 3), (3, 0)], "id int, n int")
    repeated = repeat_rows(df, F.col("n"), chunk=1000)
    per_task = repeated.groupBy(F.spark_partition_id().alias("task"), "id").count().collect()
    assert sum(r["count"] for r in per_task if r["id"] == 1) == 100_000
    assert sum(r["count"] for r in per_task if r["id"] == 2) == 3
    assert max(r["count"] for r in per_task) < 50_000


def test_rows_repeated_seldom_are_not_exchanged(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(100)], "id int, n int")
    repeated = repeat_rows(df, F.col("n"), chunk=10)
    assert repeated.count() == sum(i % 5 for i in range(100))
    few = [r["task"] for r in repeated.select(F.spark_partition_id().alias("task")).distinct().collect()]
    assert len(few) <= df.rdd.getNumPartitions()


def test_the_number_of_chunk_partitions_follows_aqe(spark):
    df = spark.createDataFrame([(1, 100)], "id int, n int")
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.set(key, "23")
    try:
        assert "Repartition 23, true" in repeat_rows(df, F.col("n"))._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset(key)
    assert "Repartition 5, true" in repeat_rows(df, F.col("n"), partitions=5)._jdf.queryExecution().analyzed().toString()


def test_a_hot_account_is_combined_before_the_exchange(spark, small_dir):
    """A task sends at most a row per (bucket, account, model, hour), however many calls the account has.

    The second exchange is of those hour rows, of which an account has one per bucket, model and different hour.
    """
    lines = physical(QUERIES["r2_partner_usage"](spark, small_dir)).splitlines()
    exchanges = [
        (line, below) for line, below in zip(lines, lines[1:], strict=False) if "Exchange hashpartitioning(" in line
    ]
    of_log = [below for line, below in exchanges if "_groupingexpression" in line]
    assert len(of_log) == 1 and "partial_sum(call_weight_from_sampling" in of_log[0]
    assert [line for line, _ in exchanges if "REPARTITION_BY_COL" in line and "hashpartitioning(account_id" in line]


def test_hour_rows_are_placed_once_for_buckets_and_join(spark, small_dir, without_broadcast):
    plan = physical(QUERIES["r2_partner_usage"](spark, small_dir))
    # The log by hour; the hours by account; the account dimension twice (copies, join), and its own join; calendar.
    by_account = [line for line in plan.splitlines() if "Exchange hashpartitioning(account_id" in line]
    assert len([line for line in by_account if "industry_vertical" not in line]) == 2  # hours, and the dimension
