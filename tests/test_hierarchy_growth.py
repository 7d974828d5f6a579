import pytest
from builders import as_dicts, day, money, table
from pyspark.sql import functions as F

from bizmetrics.operators import month_spine, prior_period
from bizmetrics.plans import hierarchy_growth as growth
from bizmetrics.queries import QUERIES

PRODUCTS = [
    (1, "Analytics", "G1", "N1"),
    (2, "Analytics", "G1", "N2"),
    (3, "Analytics", None, "N3"),
    (4, "Storage", "G9", "N9"),
]


def sources(spark, revenue, products=PRODUCTS):
    rows = [(day(m), c, p, money(a), money(r)) for m, c, p, a, r in revenue]
    return {"revenue": table(spark, "revenue", rows), "hierarchy": table(spark, "hierarchy", products)}


def by_object(df, level):
    return {
        (str(r["month_end_date"]), r["aggregation_object"]): r for r in as_dicts(df) if r["aggregation_level"] == level
    }


def test_products_of_other_categories_or_without_hierarchy_drop_out(spark):
    src = sources(spark, [("2024-01-31", 1, 1, 10, 1), ("2024-01-31", 1, 4, 20, 2), ("2024-01-31", 1, 77, 30, 3)])
    rows = as_dicts(growth.revenue_base(src))
    assert [(r["product_name"], r["acv"]) for r in rows] == [("N1", money("10.00"))]


def test_the_category_is_a_parameter(spark):
    src = sources(spark, [("2024-01-31", 1, 1, 10, 1), ("2024-01-31", 1, 4, 20, 2)])
    assert [r["product_name"] for r in as_dicts(growth.revenue_base(src, "Storage"))] == ["N9"]


def test_customers_are_counted_anew_at_every_level(spark):
    # Customer 1 buys both products of the group: once per name, once in group and category.
    src = sources(
        spark,
        [
            ("2024-01-31", 1, 1, 10, 1),
            ("2024-01-31", 1, 2, 20, 2),
            ("2024-01-31", 2, 2, 40, 4),
            ("2024-01-31", None, 2, 80, 8),
        ],
    )
    metrics = growth.level_metrics(growth.revenue_base(src))
    month = "2024-01-31"
    names = by_object(metrics, "Product Name")
    assert (names[month, "N1"]["num_customers"], names[month, "N2"]["num_customers"]) == (1, 2)
    group = by_object(metrics, "Product Group")[month, "G1"]
    category = by_object(metrics, "Product Category")[month, "Analytics"]
    for row in (group, category):
        assert (row["num_customers"], row["total_acv"], row["total_mrr"]) == (2, 150, 15)


def test_a_null_group_is_an_object_of_its_own_level_only(spark):
    src = sources(spark, [("2024-01-31", 1, 1, 10, 1), ("2024-01-31", 2, 3, 20, 2)])
    metrics = growth.level_metrics(growth.revenue_base(src))
    groups = by_object(metrics, "Product Group")
    assert {obj for _, obj in groups} == {"G1", None}
    assert groups["2024-01-31", None]["total_acv"] == 20
    assert {obj for _, obj in by_object(metrics, "Product Category")} == {"Analytics"}


def monthly(n, skip=()):
    """Revenue of month number k is k, over ``n`` months from January 2023."""
    months = [f"{2023 + k // 12}-{k % 12 + 1:02d}-01" for k in range(n)]
    return [(m, 1, 1, k + 1, k + 1) for k, m in enumerate(months) if k not in skip]


def test_the_prior_year_is_twelve_rows_back_even_over_a_gap(spark):
    # Without June 2023, June 2024 compares to May 2023, and January 2024 has only 11 rows before it.
    src = sources(spark, monthly(19, skip={5}))
    rows = by_object(growth.hierarchy_growth(src), "Product Category")
    assert rows["2024-01-01", "Analytics"]["total_acv_prior_year"] is None
    assert rows["2024-02-01", "Analytics"]["total_acv_prior_year"] == 1
    assert rows["2024-07-01", "Analytics"]["total_acv_prior_year"] == 7
    assert rows["2024-06-01", "Analytics"]["total_acv_prior_year"] == 5


def test_the_prior_year_by_calendar(spark):
    src = sources(spark, monthly(19, skip={5}))
    rows = by_object(growth.hierarchy_growth(src, by_calendar=True), "Product Category")
    assert rows["2024-01-01", "Analytics"]["total_acv_prior_year"] == 1
    assert rows["2024-06-01", "Analytics"]["total_acv_prior_year"] is None
    assert rows["2024-07-01", "Analytics"]["total_acv_prior_year"] == 7
    assert rows["2023-12-01", "Analytics"]["total_acv_prior_year"] is None


def test_growth_is_null_when_the_prior_value_is_null_or_zero(spark):
    revenue = [(m, c, p, 0 if k == 0 else a, r) for k, (m, c, p, a, r) in enumerate(monthly(14))]
    rows = by_object(growth.hierarchy_growth(sources(spark, revenue)), "Product Name")
    assert rows["2023-12-01", "N1"]["yoy_growth_acv"] is None
    assert rows["2024-01-01", "N1"]["yoy_growth_acv"] is None
    assert rows["2024-01-01", "N1"]["yoy_growth_mrr"] == 12.0
    assert rows["2024-02-01", "N1"]["yoy_growth_acv"] == 6.0
    assert rows["2024-01-01", "N1"]["yoy_growth_customers"] == 0.0


def test_null_objects_have_their_own_series(spark):
    revenue = monthly(13) + [(m, 2, 3, a + 100, 1) for m, _, _, a, _ in monthly(13)]
    rows = by_object(growth.hierarchy_growth(sources(spark, revenue)), "Product Group")
    assert rows["2024-01-01", None]["total_acv_prior_year"] == 101
    assert rows["2024-01-01", "G1"]["total_acv_prior_year"] == 1


def test_order_is_latest_month_first_then_level_and_object_nulls_first(spark):
    src = sources(spark, [(m, 1, p, 1, 1) for m in ("2024-01-31", "2024-02-29") for p in (1, 2, 3)])
    rows = growth.hierarchy_growth(src).collect()
    seen = [(str(r["month_end_date"]), r["aggregation_level"], r["aggregation_object"]) for r in rows]
    one_month = [
        ("Product Category", "Analytics"),
        ("Product Group", None),
        ("Product Group", "G1"),
        ("Product Name", "N1"),
        ("Product Name", "N2"),
        ("Product Name", "N3"),
    ]
    assert seen == [(m, *at) for m in ("2024-02-29", "2024-01-31") for at in one_month]


def test_columns(spark):
    assert growth.hierarchy_growth(sources(spark, monthly(1))).columns == [
        "month_end_date",
        "aggregation_level",
        "aggregation_object",
        "num_customers",
        "total_acv",
        "total_mrr",
        "num_customers_prior_year",
        "total_acv_prior_year",
        "total_mrr_prior_year",
        "yoy_growth_customers",
        "yoy_growth_acv",
        "yoy_growth_mrr",
    ]


@pytest.mark.parametrize(("label", "column"), growth.LEVELS.items())
def test_all_levels_at_once_equal_one_level_at_a_time(spark, small_dir, label, column):
    together = QUERIES["s05_hierarchy_grouping_sets"](spark, small_dir).where(F.col("aggregation_level") == label)
    key = {"Product Group": "s02_group_metrics", "Product Name": "s03_name_metrics"}.get(label, "s04_category_metrics")
    alone = QUERIES[key](spark, small_dir)
    ours = together.drop("aggregation_level").withColumnRenamed("aggregation_object", column)
    assert ours.select(alone.columns).exceptAll(alone).isEmpty()
    assert alone.exceptAll(ours.select(alone.columns)).isEmpty()


def test_one_fan_out_equals_grouping_sets(spark, small_dir):
    base = QUERIES["s01_revenue_base"](spark, small_dir)
    columns = list(growth.LEVELS.values())
    sets = base.groupingSets([["month_end_date", c] for c in columns], "month_end_date", *columns).agg(
        F.count_distinct("customer_id").alias("num_customers"),
        F.sum("acv").alias("total_acv"),
        F.coalesce(*[F.when(F.grouping(c) == 0, label) for label, c in growth.LEVELS.items()]).alias("level"),
    )
    expected = {
        (r["month_end_date"], r["level"], r["product_group"] or r["product_name"] or r["product_category"]): (
            r["num_customers"],
            pytest.approx(r["total_acv"]),
        )
        for r in sets.collect()
    }
    rows = QUERIES["s05_hierarchy_grouping_sets"](spark, small_dir).collect()
    ours = {
        (r["month_end_date"], r["aggregation_level"], r["aggregation_object"]): (r["num_customers"], r["total_acv"])
        for r in rows
    }
    assert ours == expected
    assert len(ours) == len(rows)


def test_on_a_spine_rows_and_calendar_agree(spark):
    rows = [("a", "2023-11-30", 1), ("a", "2024-02-29", 2), ("a", "2024-03-31", 4), (None, "2024-01-31", 8), (None, "2024-03-31", 16), ("b", "2024-05-31", 32)]
    df = spark.createDataFrame([(o, day(m), v) for o, m, v in rows], "obj string, month date, v int")
    spine = month_spine(df, ["obj"], "month")
    by_rows, by_calendar = (
        sorted(map(str, prior_period(spine, ["obj"], "month", ["v"], 2, by_calendar=c).collect())) for c in (False, True)
    )
    assert by_rows == by_calendar
    found = {(r["obj"], str(r["month"])): (r["v"], r["v_prior_year"]) for r in prior_period(spine, ["obj"], "month", ["v"], 2).collect()}
    assert found == {
        ("a", "2023-11-30"): (1, None), ("a", "2023-12-31"): (None, None), ("a", "2024-01-31"): (None, 1), ("a", "2024-02-29"): (2, None), ("a", "2024-03-31"): (4, None),
        (None, "2024-01-31"): (8, None), (None, "2024-02-29"): (None, None), (None, "2024-03-31"): (16, 8),
        ("b", "2024-05-31"): (32, None),
    }
    assert month_spine(df.limit(0), ["obj"], "month").collect() == []
