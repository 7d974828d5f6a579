"""Sums in limbs equal Python's integers."""

import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bizmetrics.operators import added_limbs, limb_sums, limbs_decimal, limbs_text


def text(unscaled: int, scale: int) -> str:
    digits = str(abs(unscaled)).rjust(scale + 1, "0")
    return ("-" if unscaled < 0 else "") + (f"{digits[:-scale]}.{digits[-scale:]}" if scale else digits)


def frame(spark, rows, scale):
    with localcontext() as c:
        c.prec = 60
        given = [(k, None if v is None else Decimal(v).scaleb(-scale), n) for k, v, n in rows]
    return spark.createDataFrame(given, T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DecimalType(38, scale)), T.StructField("n", T.LongType())]))


@pytest.mark.parametrize("scale", [0, 2, 9, 19, 37, 38])
def test_any_digits_and_copies(spark, scale):
    r = random.Random(scale)
    rows = [("widest", 10**38 - 1, 10**12)] * 50 + [("negative", 1 - 10**38, 2**63 - 1)] * 3 + [("least", 10**38 - 1, -(2**63))]
    rows += [("cancels", 10**38 - 1, 10**12), ("cancels", 10**38 - 1, -(10**12)), ("cancels", -7, 1), ("zero", 0, 5), ("none", None, 3), ("none", 3, None)]
    rows += [(f"g{r.randrange(5)}", r.choice([1, -1]) * r.randrange(10 ** r.randrange(1, 39)), r.randrange(-(10 ** r.randrange(1, 19)), 10**18)) for _ in range(600)]
    wanted: dict[str, int | None] = {}
    for key, value, copies in rows:
        if value is None or copies is None:
            wanted.setdefault(key, None)
        else:
            wanted[key] = (wanted.get(key) or 0) + value * copies
    kind = T.DecimalType(38, scale)
    sums = frame(spark, rows, scale).repartition(5).groupBy("k").agg(limb_sums(F.col("v"), F.col("n"), kind).alias("s"))
    found = sums.select("k", limbs_text(F.col("s"), kind).alias("text"), limbs_decimal(F.col("s"), kind).alias("number")).collect()
    assert {r["k"]: r["text"] for r in found} == {k: None if v is None else text(v, scale) for k, v in wanted.items()}
    for row in found:
        fits = wanted[row["k"]] is not None and abs(wanted[row["k"]]) < 10**38
        assert row["number"] == (Decimal(text(wanted[row["k"]], scale)) if fits else None)


def test_no_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        test_any_digits_and_copies(spark, 9)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_kept_limbs_add_up(spark):
    r, kind = random.Random(5), T.DecimalType(38, 4)
    rows = [(r.choice("ab"), r.randrange(-(10**38) + 1, 10**38), r.randrange(10**15)) for _ in range(200)]
    limbs = frame(spark, rows, 4).groupBy("k", (F.col("n") % 7).alias("day")).agg(limb_sums(F.col("v"), F.col("n"), kind).alias("s"))
    found = limbs.groupBy("k").agg(added_limbs(F.col("s")).alias("s")).select("k", limbs_text(F.col("s"), kind))
    assert dict(map(tuple, found.collect())) == {key: text(sum(v * n for k, v, n in rows if k == key), 4) for key in "ab"}
    assert frame(spark, [], 4).groupBy("k").agg(limb_sums(F.col("v"), F.col("n"), kind).alias("s")).collect() == []


def test_limbs_combine_before_the_exchange(spark):
    kind = T.DecimalType(38, 2)
    plan = frame(spark, [("a", 1, 1)], 2).groupBy("k").agg(limb_sums(F.col("v"), F.col("n"), kind).alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Python" not in plan
