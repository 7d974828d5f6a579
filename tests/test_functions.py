import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizmetrics.functions import (
    as_date,
    growth_rate,
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

D = datetime.date


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("a", "b", "expected"), [("6", "4", 1.5), ("1", "0", None), ("0", "0", None), ("NULL", "2", None), ("2", "NULL", None)]
)
def test_safe_divide(spark, a, b, expected):
    assert value(spark, safe_divide(F.expr(a), F.expr(b))) == expected


@pytest.mark.parametrize(("now", "ago", "expected"), [("150", "100", 0.5), ("5", "0", None), ("5", "NULL", None)])
def test_growth_rate_is_null_without_a_prior_value(spark, now, ago, expected):
    assert value(spark, growth_rate(F.expr(now), F.expr(ago))) == expected


def test_growth_rate_subtracts_money_exactly(spark):
    now, ago = F.expr("cast(0.30 as decimal(18,2))"), F.expr("cast(0.10 as decimal(18,2))")
    assert value(spark, growth_rate(now, ago)) == 2.0


@pytest.mark.parametrize("kind", ["decimal(38,9)", "decimal(18,2)"])
def test_growth_rate_of_wide_money_is_exact(spark, kind):
    scale = 9 if "9" in kind else 2
    now, ago = (F.lit(x).cast(kind) for x in ("0.123456789", "0.100000000"))
    exact = Decimal("0.123456789").quantize(Decimal(1).scaleb(-scale)) - Decimal("0.1")
    assert value(spark, growth_rate(now, ago, T.DecimalType(38 if scale == 9 else 18, scale))) == float(exact) / 0.1


def test_scaled_keeps_every_digit(spark):
    wide = F.lit("0.123456789").cast("decimal(38,9)")
    found = spark.range(1).select(scaled(wide, F.lit(3).cast("bigint"), T.DecimalType(38, 9)).alias("x"))
    assert found.schema["x"].dataType == T.DecimalType(38, 9)
    assert found.first()["x"] == Decimal("0.370370367")
    assert value(spark, scaled(F.lit(2.5), F.lit(3), T.DoubleType())) == 7.5
    assert value(spark, scaled(F.lit(7).cast("bigint"), F.lit(3), T.LongType())) == 21


def test_least_strict_does_not_skip_nulls(spark):
    assert value(spark, least_strict(F.lit(3), F.lit(2))) == 2
    assert value(spark, least_strict(F.lit(3), F.expr("cast(null as int)"))) is None
    assert value(spark, least_strict(F.expr("cast(null as int)"), F.lit(3))) is None


@pytest.mark.parametrize(
    ("day", "start", "end"),
    [
        ("2024-01-01", D(2024, 1, 1), D(2024, 1, 7)),
        ("2024-01-07", D(2024, 1, 1), D(2024, 1, 7)),
        ("2024-01-08", D(2024, 1, 8), D(2024, 1, 14)),
        ("2024-01-28", D(2024, 1, 22), D(2024, 1, 28)),
        ("2024-01-29", D(2024, 1, 29), D(2024, 1, 31)),
        ("2024-01-31", D(2024, 1, 29), D(2024, 1, 31)),
        ("2024-02-29", D(2024, 2, 29), D(2024, 2, 29)),
        ("2023-02-28", D(2023, 2, 22), D(2023, 2, 28)),
    ],
)
def test_buckets_count_from_the_first_of_the_month_and_end_with_it(spark, day, start, end):
    begins = month_week_start(as_date(day), F.trunc(as_date(day), "month"))
    assert value(spark, begins) == start
    assert value(spark, month_week_end(begins)) == end


def test_months_and_years_before_clamp_to_the_month_end(spark):
    assert value(spark, months_before(as_date("2024-03-31"), 1)) == D(2024, 2, 29)
    assert value(spark, years_before(as_date("2024-02-29"), 1)) == D(2023, 2, 28)


def test_as_date_takes_dates_strings_columns_and_today(spark):
    assert value(spark, as_date(D(2024, 1, 2))) == D(2024, 1, 2)
    assert value(spark, as_date("2024-01-02")) == D(2024, 1, 2)
    assert value(spark, as_date(F.lit("2024-01-02 10:00:00").cast("timestamp"))) == D(2024, 1, 2)
    assert value(spark, as_date(None) == F.current_date()) is True
    with pytest.raises(ValueError, match="month"):
        as_date("2024-13-01")


def test_hour_bucket_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 does not exist on that day in this zone.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        stamp = F.expr("timestamp_ntz'2024-03-10 02:30:59.5'")
        assert value(spark, hour_bucket(stamp)) == datetime.datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_month_label(spark):
    assert value(spark, month_label(as_date("2024-05-08"))) == "may_2024"


def test_pseudonym_key(spark):
    import hashlib

    assert value(spark, pseudonym_key(F.lit(42), "pepper")) == hashlib.sha256(b"pepper42").hexdigest()
    assert value(spark, pseudonym_key(F.expr("cast(null as bigint)"), "pepper")) is None
