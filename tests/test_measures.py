"""Measures, drill paths, row security and budget alerts."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from stars import NOW, by, cost_row, small_star

from spendlens.operators import budget, insights, measures, security
from spendlens.plans.refresh import POLICIES, refreshed
from spendlens.schema import schema
from pyspark.sql import functions as F

from spendlens.sources.tags import first_record_keys, flatten_tags


@pytest.fixture(scope="module")
def star(spark):
    return small_star(spark, cost=[
        cost_row(date(2023, 12, 31), 40), cost_row(date(2024, 1, 31), 100), cost_row(date(2024, 2, 29), 50, resource=2),
        cost_row(date(2024, 2, 28), 30, isReservationCharge=True), cost_row(date(2024, 3, 31), 8, resource=99, subscription=2),
    ])


def test_previous_month_by_cell(star):
    rows = by(measures.measures(star, ["Total Actual Cost", "Previous Month Cost", "Month over Month %"], ["yearMonth"]), "yearMonth")
    assert [(m, r["Total Actual Cost"], r["Previous Month Cost"]) for m, r in sorted(rows.items())] == [
        ("2023-12", 40, None), ("2024-01", 100, 40), ("2024-02", 80, 100), ("2024-03", 8, 80)]
    assert rows["2024-01"]["Month over Month %"] == pytest.approx(150.0) and rows["2023-12"]["Month over Month %"] is None


def test_previous_month_by_day_clamps_to_the_month_end(star):
    rows = by(measures.measure(star, "Previous Month Cost", ["date"]), "date")
    assert rows[date(2024, 3, 31)]["Previous Month Cost"] == 50  # 29 February
    assert rows[date(2024, 2, 29)]["Previous Month Cost"] is None and rows[date(2024, 1, 31)]["Previous Month Cost"] == 40


def test_previous_year(star):
    rows = by(measures.measure(star, "Previous Year Cost", ["year"]), "year")
    assert (rows[2024]["Previous Year Cost"], rows[2023]["Previous Year Cost"]) == (40, None)


def test_facts_without_member_stay_under_null(star):
    rows = by(measures.measures(star, ["Total Actual Cost", "Cost per Resource"], ["team"]), "team")
    assert {k: r["Total Actual Cost"] for k, r in rows.items()} == {"red": 170, "blue": 50, None: 8}


def test_ratios_and_blank(star):
    rows = by(measures.measures(star, ["Reservation Cost", "Reservation Coverage %", "Budget Remaining"], ["yearMonth"]), "yearMonth")
    assert rows["2024-02"]["Reservation Coverage %"] == pytest.approx(37.5)
    assert rows["2024-01"]["Reservation Cost"] is None and rows["2024-01"]["Budget Remaining"] == 9900.0


def test_grand_total_and_filter(star):
    assert measures.measure(star, "Total Actual Cost").first()[0] == 228
    assert measures.measure(star, "Total Actual Cost", where={"team": ["blue"]}).first()[0] == 50
    whole = measures.measures(star, ["Total Actual Cost", "Daily Z-Score"]).first()
    mean, spread = 228 / 5, (sum((c - 228 / 5) ** 2 for c in (40, 100, 50, 30, 8)) / 5) ** 0.5
    assert whole["Daily Z-Score"] == pytest.approx((228 - mean) / spread)


def test_projection(star):
    literal = by(measures.measure(star, "Projected EOM Spend", ["yearMonth"], as_of=NOW), "yearMonth")
    assert literal["2024-02"][1] == pytest.approx(80 / 15 * (31 - 29))
    fixed = by(measures.measure(star, "Projected EOM Spend", ["yearMonth"], as_of=NOW, corrected=True), "yearMonth")
    assert fixed["2024-02"][1] == pytest.approx(80 / 15 * 31)


def test_budget_table(spark, star):
    budgets = spark.createDataFrame([("2024-01", 400), ("2024-02", 0)], "yearMonth string, budgetAmount int")
    names = ["Budget Amount", "Budget Remaining", "Budget Remaining %", "Budget Utilization %"]
    rows = by(measures.measures(star, names, ["yearMonth"], budget=budgets), "yearMonth")
    assert tuple(rows["2024-01"])[1:] == (400.0, 300.0, 0.75, 25.0)
    assert tuple(rows["2024-02"])[1:] == (0.0, -80.0, None, None) and tuple(rows["2024-03"])[1:] == (None,) * 4


def test_one_day_cell_has_no_z(star):
    assert by(measures.measure(star, "Daily Z-Score", ["date"]), "date")[date(2024, 1, 31)]["Daily Z-Score"] is None


def test_unknown_combinations_are_refused(star):
    with pytest.raises(ValueError):
        measures.measures(star, ["Total Actual Cost", "Average CPU %"])
    with pytest.raises(ValueError):
        measures.measure(star, "Average CPU %", ["subscriptionName"])
    with pytest.raises(ValueError):
        measures.measure(star, "Previous Month Cost", ["team"])


def test_cpu_limits(spark):
    star = small_star(spark, utilization=[
        {"dateKey": 20240310, "resourceKey": k, "resourceId": "r", "avgCpuPercentage": c} for k, c in ((1, None), (2, 0.5), (3, 90))])
    names = ["Underutilized Resources", "Optimal Resources", "Overutilized Resources"]
    assert tuple(measures.measures(star, names).first()) == (1, 1, 1)
    assert tuple(measures.measures(star, names, cpu_scale=100.0).first()) == (2, 0, 1)


def test_drill_has_a_subtotal_per_level(star):
    rows = measures.drill(star, "calendar").collect()
    assert sorted((r.level, r.totalCost) for r in rows if r.level < 2) == [(0, 228), (1, 40), (1, 188)]
    assert sum(r.totalCost for r in rows if r.level == 4) == 228


def test_row_security(star):
    total = lambda s: measures.measure(s, "Total Actual Cost").first()[0]
    assert total(security.secured(star, "Retail")) == 220
    assert total(security.secured(star, "blue")) == 50
    assert total(security.secured(star, "nobody")) is None
    admin = security.secured(star, "admin@company.com")
    assert total(admin) is None and admin.dim_subscription.count() == 2  # no resource rule exception
    assert [r.subscriptionName for r in security.visible_subscriptions(star, "user").collect()] == ["Dev"]


def test_refresh_windows(star):
    policy = POLICIES["fact_cost_daily"]
    assert (policy.keep_from(NOW), policy.reload_from(NOW)) == (date(2023, 2, 15), date(2024, 3, 12))
    fresh = star.fact_cost_daily.filter("dateKey >= 20240301")
    days = [r.dateKey for r in refreshed(star.fact_cost_daily, fresh, policy, NOW).orderBy("dateKey").collect()]
    assert days == [20231231, 20240131, 20240228, 20240229, 20240331]


def alert(spend, limit, name="b", **more):
    return {"budgetName": name, "threshold": "90", "currentSpend": spend, "budgetAmount": limit, "subscriptionId": "sub-1", **more}


@pytest.mark.parametrize("spend, severity, action", [
    (75.0, "Low", "INFO"), (75.01, "Medium", "WARNING"), (90.0, "Medium", "WARNING"), (90.5, "High", "URGENT"),
    (100.0, "High", "URGENT"), (100.01, "High", "IMMEDIATE"),
])
def test_alert_limits_are_strict(spark, spend, severity, action):
    df = spark.createDataFrame([alert(spend, 100.0)], schema("budget_alert"))
    row = budget.classify_alerts(df).first()
    assert (row.severity, row.actionRequired.split()[0].rstrip(":")) == (severity, action)


def test_alert_texts_and_zero_budget(spark):
    df = spark.createDataFrame([alert(12.5, 0.0, subscriptionName="Dev"), alert(None, 1.0)], schema("budget_alert"))
    rows = budget.alert_texts(budget.classify_alerts(df)).collect()
    assert len(rows) == 1 and budget.rejected(df).count() == 1
    assert (rows[0].severity, rows[0].utilizationPercentage, rows[0].ticketType, rows[0].ticketPriority) == ("High", None, "Bug", "1")
    df = spark.createDataFrame([alert(1500.0, 2000.0, subscriptionName="Dev", timeGenerated="T")], schema("budget_alert"))
    row = budget.alert_texts(budget.classify_alerts(df)).first()
    assert row.alertMessage.split("\n") == [
        "🚨 Budget Alert: b", "", "Subscription: Dev", "Current Spend: $1500", "Budget Amount: $2000", "Threshold: 90%",
        "Time: T", "", "Budget utilization: 75%"]
    assert row.mailSubject == "[Low] Budget Alert: b - Dev" and "<br>Time: T<br>" in row.mailBody
    assert (row.cardColor, row.importance) == ("Good", "Normal")


def test_budget_crossings(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, d), 30) for d in (1, 2, 5, 9)])
    budgets = spark.createDataFrame([("sub-1", 2024, 3, 100)], "subscriptionId string, year int, month int, budgetAmount int")
    rows = by(insights.budget_crossings(star, budgets), "threshold")
    assert {t: r.reachedOn.day for t, r in rows.items()} == {50: 2, 75: 5, 90: 5, 100: 9}


def test_tags(spark):
    df = spark.createDataFrame([(1, '{"env": "a", "team": "x"}'), (2, None), (3, '{"env": "b", "new": 1}')], "id int, tags string").coalesce(1)
    assert first_record_keys(df, "id") == ["env", "team"]
    first = flatten_tags(df, first_record_keys(df, "id"))
    assert [tuple(r) for r in first.collect()] == [(1, "a", "x"), (2, None, None), (3, "b", None)]
    for shuffled in (df, df.repartition(3), df.orderBy(F.desc("id"))):
        every = flatten_tags(shuffled).orderBy("id")
        assert every.columns == ["id", "env", "new", "team"]
        assert [tuple(r) for r in every.collect()] == [(1, "a", None, "x"), (2, None, None, None), (3, "b", "1", None)]
    assert [tuple(r) for r in flatten_tags(df, ["new"]).collect()] == [(1, None), (2, None), (3, "1")]


def test_linear_forecast(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, d), 10 * d) for d in range(1, 11)])
    rows = by(insights.linear_forecast(star, datetime(2024, 3, 10)), "forecastHorizonDays")
    assert rows[30].forecastedCost == pytest.approx(400) and rows[30].confidenceIntervalUpper == pytest.approx(400)
    assert rows[90].dateKey == 20240608
