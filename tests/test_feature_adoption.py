from builders import as_dicts, day, table
from pyspark.sql import functions as F

from bizmetrics.plans import feature_adoption as adoption
from bizmetrics.queries import QUERIES

AS_OF = "2024-01-31"
REPORT_DAY = "2024-01-30"
PAGE = "/z/security/analytics"

USERS = [(1, 10, "pro", True), (2, 10, "pro", True), (3, 20, "free", True), (4, 20, None, True)]
ACCOUNTS = [(10, 100, True), (20, 200, True)]


def sources(spark, **tables):
    tables = {"users": USERS, "accounts": ACCOUNTS, "orgs": [(100, "O100")], **tables}
    names = ("users", "accounts", "orgs", "rules", "analytics", "settings", "interactions")
    return {n: table(spark, n, tables.get(n, [])) for n in names}


def report(spark, rollup_adoption=False, **tables):
    rows = as_dicts(adoption.feature_adoption(sources(spark, **tables), AS_OF, rollup_adoption))
    return {(r["subscription_plan"], r["metric_name"]): r for r in rows}


def flags(spark, flag, **tables):
    rows = as_dicts(adoption.user_flags(sources(spark, **tables), AS_OF))
    return {r["user_id"] for r in rows if r[flag]}


def on(date):
    return day(date)


def test_only_active_users_of_active_accounts(spark):
    src = sources(
        spark,
        users=[(1, 10, "pro", True), (2, 10, "pro", False), (3, 10, "pro", None), (4, 30, "pro", True), (5, 40, "x", True)],
        accounts=[(10, 100, True), (30, 100, False), (40, 100, None)],
    )
    assert [r["user_id"] for r in as_dicts(adoption.active_entities(src))] == [1]


def test_an_account_without_organisation_stands_for_itself(spark):
    src = sources(spark, accounts=[(10, 100, True), (20, 999, True)], orgs=[(100, "O100"), (200, None)])
    found = {r["account_id"]: r["organization_id"] for r in as_dicts(adoption.active_entities(src))}
    assert found == {10: "O100", 20: "20"}
    src = sources(spark, orgs=[(100, "O100"), (200, None)])
    found = {r["account_id"]: r["organization_id"] for r in as_dicts(adoption.active_entities(src))}
    assert found == {10: "O100", 20: "20"}


def test_rule_flags_are_ored_over_the_report_day(spark):
    d = on(REPORT_DAY)
    rules = [
        (1, d, False),
        (1, d, True),
        (1, d, None),
        (2, d, None),
        (3, d, False),
        (4, on("2024-01-29"), True),
        (4, on("2024-01-31"), True),
        (None, d, True),
    ]
    assert flags(spark, adoption.RULE, rules=rules) == {1}


def test_proxied_traffic_on_the_report_day(spark):
    d = on(REPORT_DAY)
    analytics = [(1, d, True), (1, d, True), (2, d, False), (3, d, None), (4, on("2024-01-29"), True)]
    assert flags(spark, adoption.PROXY, analytics=analytics) == {1}


def test_settings_have_no_date(spark):
    assert flags(spark, adoption.SETTING, settings=[(1, True), (2, False), (3, None)]) == {1}


def test_dashboard_views_span_the_report_day_and_the_seven_days_before(spark):
    views = [
        (on("2024-01-22"), (1, PAGE)),
        (on("2024-01-23"), (2, PAGE)),
        (on(REPORT_DAY), (3, "/deep/path" + PAGE)),
        (on("2024-01-31"), (4, PAGE)),
        (on(REPORT_DAY), (4, PAGE + "/x")),
        (on(REPORT_DAY), None),
    ]
    assert flags(spark, adoption.DASHBOARD, interactions=views) == {2, 3}


def test_flags_are_never_null_and_users_are_not_repeated(spark):
    rows = as_dicts(adoption.user_flags(sources(spark, settings=[(1, True), (1, True), (2, None)]), AS_OF))
    assert len(rows) == 4
    assert all(r[f] in (True, False) for r in rows for f in adoption.FLAGS)


def test_copies_of_a_user_count_once(spark):
    users = [(1, 10, "pro", True), (1, 10, "pro", True), (2, 10, "pro", True)]
    tables = {"users": users, "settings": [(1, True), (1, True)]}
    repeated = adoption.user_flags_per_setting(sources(spark, **tables), AS_OF)
    assert sorted(r["user_id"] for r in as_dicts(repeated)) == [1, 1, 1, 1, 2]
    row = report(spark, **tables)["pro", "Company Setting"]
    assert (row["adopted_users"], row["total_users"]) == (1, 2)


def test_a_row_per_enabled_setting_where_asked(spark):
    src = sources(spark, settings=[(1, True), (1, True), (1, False), (2, None), (99, True)])
    rows = as_dicts(adoption.user_flags_per_setting(src, AS_OF))
    assert sorted(r["user_id"] for r in rows) == [1, 1, 2, 3, 4]


def test_repeated_settings_do_not_count_twice(spark):
    rows = report(spark, settings=[(1, True), (1, True), (2, True)])
    assert rows["pro", "Company Setting"]["adopted_users"] == 2
    assert rows["pro", "Company Setting"]["adopted_accounts"] == 1


def test_counts_and_shares(spark):
    rows = report(spark, settings=[(1, True)], analytics=[(2, on(REPORT_DAY), True), (3, on(REPORT_DAY), True)])
    row = rows["pro", "Company Setting"]
    assert (row["adopted_users"], row["total_users"], row["pct_adoption_users"]) == (1, 2, 0.5)
    assert (row["adopted_orgs"], row["total_orgs"], row["pct_adoption_orgs"]) == (1, 1, 1.0)
    assert rows["pro", "Analytics Dashboard"]["adopted_users"] == 1
    assert rows["free", "Analytics Dashboard"]["adopted_users"] == 1
    assert row["report_date"] == day(REPORT_DAY)
    assert row["scenario"] == "Adopted vs. Total Active"


def test_all_row_has_totals_over_plans_and_no_metric(spark):
    rows = report(spark, settings=[(1, True)])
    total = rows["All", None]
    assert (total["total_users"], total["total_accounts"], total["total_orgs"]) == (4, 2, 2)
    assert (total["adopted_users"], total["pct_adoption_users"]) == (0, 0.0)
    assert [m for p, m in rows if p == "All"] == [None]


def test_all_row_with_rolled_up_adoption(spark):
    rows = report(spark, rollup_adoption=True, settings=[(1, True), (3, True), (4, True)])
    assert rows["All", "Company Setting"]["adopted_users"] == 3
    assert rows["All", "Company Setting"]["adopted_accounts"] == 2
    assert ("All", None) not in rows
    assert rows["free", "Company Setting"]["adopted_users"] == 1
    assert (None, None) in rows


def test_a_null_plan_is_not_the_total_and_has_no_metric(spark):
    rows = report(spark, settings=[(4, True)])
    assert rows[None, None]["total_users"] == 1
    assert rows[None, None]["adopted_users"] == 0
    assert [m for p, m in rows if p is None] == [None]


def test_a_plan_without_adopters_has_one_row_without_metric(spark):
    rows = report(spark, settings=[(1, True)])
    assert [m for p, m in rows if p == "free"] == [None]
    assert [m for p, m in rows if p == "pro"] == ["Company Setting"]


def test_a_plan_called_all_lends_its_counts_to_the_total(spark):
    users = [(1, 10, "All", True), (2, 10, "pro", True)]
    result = as_dicts(adoption.feature_adoption(sources(spark, users=users, settings=[(1, True), (2, True)]), AS_OF))
    rows = sorted((r["subscription_plan"], r["metric_name"], r["adopted_users"], r["total_users"]) for r in result)
    assert rows == [
        ("All", "Company Setting", 1, 1),
        ("All", "Company Setting", 1, 2),
        ("pro", "Company Setting", 1, 1),
    ]


def test_null_ids_are_not_counted(spark):
    users = [(None, 10, "pro", True), (1, 10, "pro", True), (1, 20, "pro", True)]
    row = report(spark, users=users)["pro", None]
    assert (row["total_users"], row["total_accounts"]) == (1, 2)


def test_order_is_plan_then_metric_nulls_first(spark):
    result = adoption.feature_adoption(
        sources(spark, settings=[(1, True), (3, True)], analytics=[(1, on(REPORT_DAY), True)]), AS_OF
    )
    assert [(r["subscription_plan"], r["metric_name"]) for r in result.collect()] == [
        (None, None),
        ("All", None),
        ("free", "Company Setting"),
        ("pro", "Analytics Dashboard"),
        ("pro", "Company Setting"),
    ]


def test_report_equals_the_join_of_its_stages(spark, small_dir):
    totals = QUERIES["s15_plan_totals"](spark, small_dir)
    counts = QUERIES["s14_adoption_long"](spark, small_dir).withColumnRenamed("subscription_plan", "plan")
    joined = totals.join(counts, totals["subscription_plan"] == counts["plan"], "left").select(
        "subscription_plan",
        "metric_name",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("adopted_users", "adopted_accounts", "adopted_orgs")],
        "total_users",
        "total_accounts",
        "total_orgs",
    )
    ours = QUERIES["r3_product_adoption"](spark, small_dir).select(joined.columns)
    assert ours.count() == joined.count() > 0
    assert ours.exceptAll(joined).isEmpty()


def test_one_pass_over_flags_equals_a_filtered_pass_per_flag(spark, small_dir):
    flagged = QUERIES["s13_feature_flags"](spark, small_dir)
    passes = None
    for flag, label in adoption.FLAGS.items():
        counted = (
            flagged.where(flag)
            .groupBy("subscription_plan")
            .agg(
                F.count_distinct("user_id").alias("adopted_users"),
                F.count_distinct("account_id").alias("adopted_accounts"),
                F.count_distinct("organization_id").alias("adopted_orgs"),
            )
            .select(F.lit(label).alias("metric_name"), "*")
        )
        passes = counted if passes is None else passes.union(counted)
    ours = QUERIES["s14_adoption_long"](spark, small_dir)
    assert ours.exceptAll(passes).isEmpty()
    assert passes.exceptAll(ours).isEmpty()


def test_adopted_never_exceeds_total(spark, small_dir):
    for row in QUERIES["r3_product_adoption"](spark, small_dir).collect():
        for entity in adoption.ENTITIES:
            assert row[f"adopted_{entity}"] <= row[f"total_{entity}"]
