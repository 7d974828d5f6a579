import datetime

import pytest
from builders import as_dicts, day, money, table
from pyspark.sql import functions as F

from bizmetrics.functions import pseudonym_key
from bizmetrics.operators import approx_percentiles, usage_by_bucket
from bizmetrics.plans import model_usage as usage
from bizmetrics.queries import QUERIES
from bizmetrics.sources import calendar

SALT = "pepper"
AS_OF = "2024-02-15"
X1 = "partner-a/model-family-x-1"
Y1 = "partner-a/model-family-y-1"


def call(account, stamp, model=X1, error=0, weight=1, tokens=(0, 0), ttft=None, duration=None):
    at = datetime.datetime.fromisoformat(stamp)
    return (account, at, at.date(), model, error, weight, *tokens, money(ttft), money(duration))


def sources(spark, calls, accounts=()):
    return {
        "logs": table(spark, "logs", calls),
        "accounts_dim": table(spark, "accounts_dim", accounts),
        "calendar": calendar(spark, "2023-12-01", "2024-03-31"),
    }


def report(spark, calls, accounts=(), **options):
    return as_dicts(usage.model_usage(sources(spark, calls, accounts), SALT, AS_OF, **options))


def test_eligible_dates_are_the_previous_month_in_buckets_from_the_first(spark):
    rows = usage.eligible_dates(calendar(spark, "2023-01-01", "2025-01-01"), "2024-03-31").orderBy("date").collect()
    assert (rows[0]["date"], rows[-1]["date"], len(rows)) == (day("2024-02-01"), day("2024-02-29"), 29)
    starts = sorted({str(r["first_day_of_week"]) for r in rows})
    assert starts == ["2024-02-01", "2024-02-08", "2024-02-15", "2024-02-22", "2024-02-29"]


def test_only_successful_calls_of_the_partner_last_month_count(spark):
    rows = report(
        spark,
        [
            call(1, "2024-01-01T10:00", weight=1),
            call(1, "2024-01-01T10:00", weight=2, error=1),
            call(1, "2024-01-01T10:00", weight=4, error=None),
            call(1, "2024-01-01T10:00", weight=8, model="partner-b/other-1"),
            call(1, "2024-01-01T10:00", weight=16, model="partner-a/model-family-z-1"),
            call(1, "2023-12-31T23:59", weight=32),
            call(1, "2024-02-01T00:00", weight=64),
        ],
    )
    assert [r["total_call_volume"] for r in rows] == [1]


def test_other_partners_by_prefix(spark):
    rows = report(spark, [call(1, "2024-01-01T10:00", model="partner-b/other-1")], prefixes=["partner-b/"])
    assert [r["model"] for r in rows] == ["partner-b/other-1"]


def test_the_last_bucket_ends_with_the_month(spark):
    (row,) = report(spark, [call(1, "2024-01-30T10:00")])
    assert (row["report_week_start"], row["report_week_end"]) == (day("2024-01-29"), day("2024-01-31"))
    assert (row["report_month"], row["deployment_type"]) == ("january_2024", "cloud_hosted")


def test_volumes_are_weighted_and_latencies_are_not(spark):
    (row,) = report(
        spark,
        [
            call(1, "2024-01-01T10:00", weight=9, tokens=(5, 7), ttft=10, duration=100),
            call(1, "2024-01-01T11:00", weight=1, tokens=(6, 8), ttft=20, duration=None),
            call(1, "2024-01-02T11:00", weight=1, tokens=(None, 1), ttft=None, duration=300),
        ],
    )
    assert (row["total_call_volume"], row["total_input_tokens"], row["total_output_tokens"]) == (11, 11, 16)
    assert (row["avg_ttft_ms"], row["avg_inference_time_ms"]) == (15.0, 200.0)


def test_averages_without_values_are_null(spark):
    (row,) = report(spark, [call(1, "2024-01-01T10:00")])
    assert row["avg_ttft_ms"] is None


def test_percentiles_run_over_hours_with_traffic(spark):
    # Hours 1..10 have volumes 1..10; the other hours of the week do not count as 0.
    (row,) = report(spark, [call(1, f"2024-01-01T{h:02d}:30", weight=h) for h in range(1, 11)])
    assert (row["p20_hourly_call_volume"], row["p50_hourly_call_volume"], row["p80_hourly_call_volume"]) == (2, 5, 8)
    assert row["peak_hourly_call_volume"] == 10


def test_usage_without_an_account_has_totals_but_no_percentiles(spark):
    rows = report(spark, [call(None, "2024-01-01T10:00", weight=3), call(1, "2024-01-01T10:00", weight=5)])
    nobody, somebody = rows
    assert (nobody["customer_uuid"], nobody["total_call_volume"]) == (None, 3)
    assert nobody["peak_hourly_call_volume"] is None
    assert nobody["p50_hourly_call_volume"] is None
    assert somebody["peak_hourly_call_volume"] == 5


def test_an_account_without_a_dimension_row_has_no_segment(spark):
    (row,) = report(spark, [call(1, "2024-01-01T10:00", weight=5)], [(2, "Retail", "FR")])
    assert (row["industry_vertical"], row["billing_country"], row["peak_hourly_call_volume"]) == (None, None, 5)


def test_several_segments_give_a_row_each_with_the_same_totals(spark):
    rows = report(spark, [call(1, "2024-01-01T10:00", weight=5)], [(1, "Retail", "FR"), (1, "Retail", "DE")])
    assert sorted(r["billing_country"] for r in rows) == ["DE", "FR"]
    assert {(r["total_call_volume"], r["peak_hourly_call_volume"]) for r in rows} == {(5, 5)}


def test_repeated_dimension_rows_multiply_hourly_volumes_but_not_totals(spark):
    calls = [call(1, "2024-01-01T10:00", weight=5), call(1, "2024-01-01T11:00", weight=7)]
    accounts = [(1, "Retail", "FR"), (1, "Retail", "FR")]
    (row,) = report(spark, calls, accounts)
    assert (row["total_call_volume"], row["p50_hourly_call_volume"], row["peak_hourly_call_volume"]) == (12, 10, 14)
    src = sources(spark, calls, accounts)
    hours = usage.hourly_volume(usage.calls_by_hour(src, AS_OF), src["accounts_dim"], SALT)
    assert sorted(r["hourly_api_calls"] for r in hours.collect()) == [10, 14]


def test_rows_are_ordered_by_week_then_customer_nulls_first(spark):
    calls = [
        call(account, f"2024-01-{d:02d}T10:00", model=m) for d in (9, 1) for account in (None, 1, 2, 3) for m in (X1, Y1)
    ]
    keys = [(r["report_week_start"], r["customer_uuid"] or "") for r in report(spark, calls)]
    assert keys == sorted(keys)
    assert len(keys) == 16


def test_report_equals_the_join_of_its_stages(spark):
    accounts = [(1, "Retail", "FR"), (1, "Retail", "FR"), (1, "Banking", "FR"), (2, None, "DE")]
    calls = [
        call(a, f"2024-01-{d:02d}T{h:02d}:15", model=m, weight=d + h, tokens=(d, h), ttft=d, duration=h)
        for a in (None, 1, 2, 3)
        for d in (1, 6, 12, 31)
        for h in (0, 5, 17)
        for m in (X1, Y1)
    ]
    src = sources(spark, calls, accounts)
    hours = usage.calls_by_hour(src, AS_OF)
    summary = usage.usage_summary(hours, SALT)
    stats = usage.volume_percentiles(hours, src["accounts_dim"], SALT)
    on = [summary[c] == stats[c] for c in ("week_start_date", "customer_uuid", "model")]
    columns = ["total_call_volume", "total_input_tokens", *usage.AVERAGES, *usage.SEGMENTS, *usage.PERCENTILE_POINTS]
    columns.append(usage.PEAK)
    joined = summary.join(stats, on, "left").select(
        summary["customer_uuid"], summary["week_start_date"].alias("report_week_start"), summary["model"], *columns
    )
    ours = usage.model_usage(src, SALT, AS_OF).select(joined.columns)
    assert ours.count() == joined.count() == 4 * 2 * 3 + 3 * 2  # account 1 has a second segment
    assert ours.exceptAll(joined).isEmpty()


def test_customer_keys_are_the_salted_hash_of_the_account(spark):
    (row,) = report(spark, [call(7, "2024-01-01T10:00")])
    assert row["customer_uuid"] == spark.range(7, 8).select(pseudonym_key(F.col("id"), SALT)).first()[0]


def nearest_ranks(n):
    """The smallest value with at least 20, 50 and 80 % of the values 0, 3, 6, … at or below it."""
    return [3 * (-(-n * k // 10) - 1) for k in (2, 5, 8)]


@pytest.mark.parametrize("n", [1, 2, 5, 24, 99, 168, 744])
def test_percentiles_are_at_the_nearest_rank(spark, n):
    hours = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") * 3).alias("v"))
    points = {"p20": 20, "p50": 50, "p80": 80}
    exact = usage_by_bucket(hours, ["k"], "v", points, "peak", F.sum("v").alias("total")).first()
    assert [exact[p] for p in points] == nearest_ranks(n)
    assert (exact["peak"], exact["total"]) == (3 * (n - 1), 3 * n * (n - 1) // 2)
    sketched = hours.agg(*approx_percentiles("v", points)).first()
    assert list(sketched) == nearest_ranks(n)


def test_sketched_percentiles_of_a_large_group_are_near_their_rank(spark):
    sketched = spark.range(300_000).agg(*approx_percentiles("id", {"p20": 20, "p80": 80})).first()
    assert sketched["p20"] == pytest.approx(60_000, abs=60)
    assert sketched["p80"] == pytest.approx(240_000, abs=60)


def test_percentiles_skip_null_volumes(spark):
    hours = spark.createDataFrame([("a", None), ("a", 5), ("a", 7), ("b", None)], "k string, v bigint")
    found = {r["k"]: tuple(r)[1:] for r in usage_by_bucket(hours, ["k"], "v", {"p50": 50}, "peak").collect()}
    assert found == {"a": (5, 7), "b": (None, None)}
    sketched = {r["k"]: r["p50"] for r in hours.groupBy("k").agg(*approx_percentiles("v", {"p50": 50})).collect()}
    assert sketched == {"a": 5, "b": None}


def test_percentiles_are_nested_below_the_peak(spark, small_dir):
    rows = QUERIES["r2_partner_usage"](spark, small_dir).collect()
    known = [r for r in rows if r["customer_uuid"] is not None]
    assert known and len(known) < len(rows)
    for r in known:
        p20, p50, p80 = (r[p] for p in usage.PERCENTILE_POINTS)
        assert p20 <= p50 <= p80 <= r[usage.PEAK] <= r["total_call_volume"]


def test_wide_weights_keep_their_digits(spark):
    """A dimension row that is there twice doubles volumes and percentiles, to the last digit."""
    from decimal import Decimal

    from bizmetrics.operators import join_segments

    df = spark.createDataFrame([(1, Decimal("0.123456789"))], "account_id bigint, volume decimal(38,9)")
    dim = spark.createDataFrame([(1, "V"), (1, "V")], "account_id bigint, vertical string")
    joined = join_segments(df, dim, "account_id", ["vertical"], ["volume"])
    assert joined.schema["volume"].dataType.scale == 9
    assert str(joined.first()["volume"]) == "0.246913578"


def test_the_zeroth_percentile_is_the_smallest(spark):
    from bizmetrics.operators import usage_by_bucket

    df = spark.createDataFrame([("k", v) for v in (5, 3, 9)], "key string, volume bigint")
    assert usage_by_bucket(df, ["key"], "volume", {"p0": 0, "p100": 100}, "peak").first().asDict() == {"key": "k", "p0": 3, "p100": 9, "peak": 9}
