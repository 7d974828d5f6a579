"""Last month's model usage of one partner: totals, latencies and hourly-volume percentiles per customer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizmetrics.functions import month_label, pseudonym_key
from bizmetrics.functions.dates import DateLike
from bizmetrics.operators.periods import bucket_days, previous_month_days, with_bucket_end
from bizmetrics.operators.sketches import merged_sketches, quantile_sketches, sketch_percentiles, sketch_size
from bizmetrics.operators.usage import (
    hourly_usage,
    join_segments,
    merged_average,
    usage_by_bucket,
)
from bizmetrics.sinks.state import PeriodState
from bizmetrics.sources.catalog import conform

# Model prefixes, percentile points, constant column, and output names.
MODEL_PREFIXES = ("partner-a/model-family-x-", "partner-a/model-family-y-")
DEPLOYMENT_TYPE = "cloud_hosted"
PERCENTILE_POINTS = {
    "p20_hourly_call_volume": 20,
    "p50_hourly_call_volume": 50,
    "p80_hourly_call_volume": 80,
}
PEAK = "peak_hourly_call_volume"
SEGMENTS = ["industry_vertical", "billing_country"]
TOTALS = {
    "total_input_tokens": "input_tokens",
    "total_output_tokens": "output_tokens",
    "total_call_volume": "hourly_api_calls",
}
AVERAGES = {
    "avg_ttft_ms": "time_to_first_token_ms",
    "avg_inference_time_ms": "inference_duration_ms",
}
HOURLY_SUMS = {
    "input_tokens": "input_tokens",
    "output_tokens": "output_tokens",
    "hourly_api_calls": "call_weight_from_sampling",
}
GRAIN = ["first_day_of_week", "account_id", "model_name"]


def eligible_dates(calendar: DataFrame, as_of: DateLike = None) -> DataFrame:
    """Days of the previous month, each with the first day of its 7-day bucket."""
    return bucket_days(previous_month_days(calendar, as_of))


def successful_calls(logs: DataFrame, prefixes: Sequence[str] = MODEL_PREFIXES) -> DataFrame:
    """Calls of the partner's models that ended without error; an unknown error code is not a success."""
    of_partner = reduce(lambda a, b: a | b, [F.col("model_name").startswith(p) for p in prefixes])
    return logs.where(of_partner & (F.col("error_code") == 0))


def calls_by_hour(
    sources: Mapping[str, DataFrame], as_of: DateLike = None, prefixes: Sequence[str] = MODEL_PREFIXES
) -> DataFrame:
    """The only read of the log: week bucket × account × model × hour.

    Accounts keep their own id here. The pseudonym is derived from it one-to-one, so hashing
    waits until there is one row per customer, and the account dimension is joined there too.
    """
    days = eligible_dates(sources["calendar"], as_of)
    calls = successful_calls(sources["logs"], prefixes)
    return hourly_usage(
        calls.join(days, calls["event_date"] == days["date"]),
        GRAIN,
        F.col("event_timestamp"),
        HOURLY_SUMS,
        list(AVERAGES.values()),
    )


def _public(df: DataFrame, salt: str, *others: str) -> DataFrame:
    """Week bounds, pseudonymous customer and model, followed by ``others``."""
    return with_bucket_end(df, "first_day_of_week", "week_end_date").select(
        F.col("first_day_of_week").alias("week_start_date"),
        "week_end_date",
        pseudonym_key(F.col("account_id"), salt).alias("customer_uuid"),
        F.col("model_name").alias("model"),
        *others,
    )


def hourly_volume(hours: DataFrame, accounts: DataFrame, salt: str) -> DataFrame:
    """Call volume per week, customer, model, segment and hour, weighted to undo the sampling."""
    volume = hours.select(*GRAIN, "hour_bucket", "hourly_api_calls")
    by_segment = join_segments(volume, accounts, "account_id", SEGMENTS, ["hourly_api_calls"])
    return _public(by_segment, salt, *SEGMENTS, "hour_bucket", "hourly_api_calls")


def volume_percentiles(hours: DataFrame, accounts: DataFrame, salt: str) -> DataFrame:
    """Percentiles and peak of hourly volume per week, customer, model and segment."""
    measures = [*PERCENTILE_POINTS, PEAK]
    per_customer = usage_by_bucket(hours, GRAIN, "hourly_api_calls", PERCENTILE_POINTS, PEAK)
    by_segment = join_segments(per_customer, accounts, "account_id", SEGMENTS, measures)
    return _public(by_segment, salt, *SEGMENTS, *measures).drop("week_end_date")


def _summary_aggregates() -> list[Column]:
    totals = [F.sum(column).alias(name) for name, column in TOTALS.items()]
    return totals + [merged_average(column).alias(name) for name, column in AVERAGES.items()]


def usage_summary(hours: DataFrame, salt: str) -> DataFrame:
    """Totals and average latencies per week, customer and model. Volumes are weighted, averages are not."""
    per_customer = hours.groupBy(*GRAIN).agg(*_summary_aggregates())
    return _public(per_customer, salt, *TOTALS, *AVERAGES)


def model_usage(
    sources: Mapping[str, DataFrame],
    salt: str,
    as_of: DateLike = None,
    prefixes: Sequence[str] = MODEL_PREFIXES,
) -> DataFrame:
    """The report: ``usage_summary`` left-joined to ``volume_percentiles`` on week, customer and model.

    Both sides of that join are aggregates of the same hours, so they are computed together
    and the log is read once. What the join would do beyond that is kept: an account with
    several segments gets a row for each, and usage without an account has totals, but no
    percentiles, as its NULL key would not match.
    """
    measures = [*PERCENTILE_POINTS, PEAK]
    per_customer = usage_by_bucket(
        # Placed by account, hour rows are ready for their buckets and for the join that follows. An
        # account has no more of them than different hours times models.
        calls_by_hour(sources, as_of, prefixes).repartition("account_id"),
        GRAIN,
        "hourly_api_calls",
        PERCENTILE_POINTS,
        PEAK,
        *_summary_aggregates(),
    )
    by_segment = join_segments(per_customer, sources["accounts_dim"], "account_id", SEGMENTS, measures)
    known = F.col("account_id").isNotNull()
    nullable = {m: F.when(known, F.col(m)) for m in measures}
    return (
        _public(by_segment.withColumns(nullable), salt, *SEGMENTS, *TOTALS, *AVERAGES, *measures)
        .select(
            month_label(F.col("week_start_date")).alias("report_month"),
            F.col("week_start_date").alias("report_week_start"),
            F.col("week_end_date").alias("report_week_end"),
            F.lit(DEPLOYMENT_TYPE).alias("deployment_type"),
            "model",
            *SEGMENTS,
            "customer_uuid",
            "total_call_volume",
            "total_input_tokens",
            "total_output_tokens",
            *measures,
            *AVERAGES,
        )
        .orderBy("report_week_start", "customer_uuid")
    )


def volume_sketches(spark: SparkSession, path: str, logs: str, prefixes: Sequence[str] = MODEL_PREFIXES) -> PeriodState:
    """Sketches of customers' hourly volumes per day, model and hour, kept at ``path``; from the directory ``logs``, partitioned by ``event_date``.

    A day is sketched when its files arrive or change, and never read again for a week or a month that it is part of. A customer's hour
    is taken within a day's log: one whose times lie on two log days counts on both.
    """

    def compute(rows: DataFrame) -> DataFrame:
        calls = successful_calls(conform(rows, "logs"), prefixes)
        volume = {"hourly_api_calls": HOURLY_SUMS["hourly_api_calls"]}
        hours = hourly_usage(calls, ["event_date", "model_name", "account_id"], F.col("event_timestamp"), volume, [])
        return quantile_sketches(hours, ["event_date", "model_name", "hour_bucket"], "hourly_api_calls")

    return PeriodState(spark, path, logs, "event_date", compute, "|".join(prefixes))


def model_volumes(sketches: DataFrame, days: DataFrame) -> DataFrame:
    """Percentiles of customers' hourly volumes per week and model, over all customers and hours, from kept sketches."""
    daily = sketches.join(days, sketches["event_date"] == days["date"])
    weekly = merged_sketches(daily, ["first_day_of_week", "model_name"])
    return weekly.select("first_day_of_week", "model_name", sketch_size().alias("customer_hours"), *sketch_percentiles(PERCENTILE_POINTS))
