"""Edge rows of the key figures and cost lookups."""

from __future__ import annotations

import statistics
from datetime import date, datetime
from decimal import Decimal

import pytest
from stars import NOW, by, cost_row, small_star

from spendlens.operators import costs, kpis


def test_previous_month_carries_over_new_year_and_skips_gaps(spark):
    star = small_star(spark, cost=[
        cost_row(date(2023, 12, 20), 100), cost_row(date(2024, 1, 5), 150), cost_row(date(2024, 1, 9), 50),
        cost_row(date(2023, 12, 20), 70, subscription=2), cost_row(date(2024, 2, 1), 90, subscription=2),
    ])
    rows = by(kpis.mom_growth(star, datetime(2024, 2, 10)), "subscriptionId", "month")
    assert rows["sub-1", 1].previousMonthCost == 100 and rows["sub-1", 1].momGrowthPercentage == pytest.approx(100.0)
    assert rows["sub-1", 1].momCostChange == 100
    gap = rows["sub-2", 2]
    assert (gap.previousMonthCost, gap.momGrowthPercentage, gap.momCostChange) == (None, 0.0, None)


def test_growth_is_zero_after_a_credit_month(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 1, 20), -5), cost_row(date(2024, 2, 5), 10)])
    row = by(kpis.mom_growth(star, NOW), "month")[2]
    assert (row.momGrowthPercentage, row.momCostChange) == (0.0, 15)


def test_previous_day_is_the_previous_present_day(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, 1), 5), cost_row(date(2024, 3, 9), 7, resource=2, meter=2),
                                   cost_row(date(2024, 3, 9), 1)])
    rows = by(kpis.executive_kpis(star, NOW), "date")
    last = rows[date(2024, 3, 9)]
    assert (last.previousDayCost, last.previousMonthCost) == (5, None)
    assert (last.activeResourceCount, last.uniqueServiceCount, last.forecastedCost) == (2, 2, 0)


def test_forecast_fills_its_column(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, 1), 5), cost_row(date(2024, 3, 2), 5)])
    forecast = spark.createDataFrame([(date(2024, 3, 2), "sub-1", 9)], "date date, subscriptionId string, forecastedCost int")
    rows = by(kpis.executive_kpis(star, NOW, forecast), "date")
    assert [rows[date(2024, 3, d)].forecastedCost for d in (1, 2)] == [0, 9]
    counts = by(kpis.executive_kpis(star, NOW, approximate_counts=True), "date")
    assert counts[date(2024, 3, 1)].activeResourceCount == 1


def test_boundary_day_needs_a_midnight_as_of(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 1, 15), 5)])
    assert kpis.mom_growth(star, datetime(2024, 3, 15)).count() == 1
    assert kpis.mom_growth(star, datetime(2024, 3, 15, 0, 1)).count() == 0


def test_equal_subscription_names_stay_apart(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, 1), 5), cost_row(date(2024, 3, 1), 6, subscription=2)])
    same = star.dim_subscription.replace({"Prod": "Dev"}, subset=["subscriptionName"])
    rows = kpis.service_cost_breakdown(star.with_tables(dim_subscription=same), NOW).collect()
    assert sorted(r.totalCost for r in rows) == [5, 6]


def test_utilization_status_and_missing_cost(spark):
    day = 20240310
    star = small_star(
        spark, cost=[cost_row(date(2024, 3, 10), 40, resource=2)],
        utilization=[{"dateKey": day, "resourceKey": k, "resourceId": f"/res/{k}", "avgCpuPercentage": cpu}
                     for k, cpu in ((1, None), (2, 20))] + [
            {"dateKey": 20240311, "resourceKey": 1, "resourceId": "/res/1", "avgCpuPercentage": 19.99},
            {"dateKey": 20240311, "resourceKey": 2, "resourceId": "/res/2", "avgCpuPercentage": 80},
            {"dateKey": 20240312, "resourceKey": 2, "resourceId": "/res/2", "avgCpuPercentage": 80.01},
            {"dateKey": 20240312, "resourceKey": 3, "resourceId": "/res/1", "avgCpuPercentage": 5},
        ])
    rows = by(kpis.resource_utilization(star, NOW), "date", "resourceKey")
    status = {k: r.utilizationStatus for k, r in rows.items()}
    assert status == {
        (date(2024, 3, 10), 1): "Optimal", (date(2024, 3, 10), 2): "Optimal", (date(2024, 3, 11), 1): "Underutilized",
        (date(2024, 3, 11), 2): "Optimal", (date(2024, 3, 12), 2): "Overutilized"}
    assert rows[date(2024, 3, 10), 2].costPerCpuPercent == 2.0
    assert rows[date(2024, 3, 10), 1].totalCost is None and rows[date(2024, 3, 10), 1].costPerCpuPercent == 0.0
    assert kpis.resource_utilization(star.as_was(), NOW).count() == 6


def test_unused_reservation_cost_by_benefit_utilization(spark):
    benefits = [{"benefitKey": k, "benefitType": "Reservation", "utilizationPercentage": u}
                for k, u in ((1, None), (2, 100), (3, 60))]
    star = small_star(spark, benefits=benefits, cost=[
        cost_row(date(2024, 3, 1), 50, benefitKey=k, isReservationCharge=True) for k in (1, 2, 3, None)
    ] + [cost_row(date(2024, 3, 1), 9)])
    rows = by(kpis.reservation_coverage(star, NOW), "benefitType", "utilizationPercentage")
    assert {k[1]: r.unusedReservationCost for k, r in rows.items() if k[0]} == {None: 0.0, Decimal("100.00"): 0.0, Decimal("60.00"): 20.0}
    assert {r.coveragePercentage for r in rows.values()} == {100.0} and (None, None) in rows


def test_service_lookups_select_one_member(spark):
    star = small_star(spark, cost=[
        cost_row(date(2024, 3, 1), 5), cost_row(date(2024, 3, 2), 7, subscription=2, resource=2, meter=2),
        cost_row(date(2024, 3, 3), 11, resource=3),
    ])
    start, end = date(2024, 3, 1), datetime(2024, 3, 3, 12)
    assert costs.total_cost(star, start, end, "sub-1").first().totalCost == 16
    assert costs.total_cost(star, start, end, "nobody").first().totalCost == 0
    assert [(r.serviceName, r.totalCost) for r in costs.cost_by_service(star, start, end).collect()] == [
        ("Compute", 16), ("Storage", 7)]
    rows = costs.cost_data_by_range(star, start, end, "sub-1").collect()
    assert [(r.date, r.actualCost) for r in rows] == [("2024-03-01", 5)]  # the expired version drops out
    assert rows[0].meterSubCategory == "" and rows[0].tags["Team"] == "red" and rows[0].tags["Project"] == ""
    assert [r.date for r in costs.cost_data_by_range(star, start, end).collect()] == ["2024-03-02", "2024-03-01"]
    assert costs.cost_data_by_resource(star, NOW, "/res/2").first().actualCost == 7
    assert costs.cost_data(star, datetime(2024, 3, 3), "sub-2", days_back=1).count() == 1


def test_rolling_band_uses_six_present_days(spark):
    history = [100, 103, 98, 101, 99, 100]
    star = small_star(spark, cost=[cost_row(date(2024, 3, 1 + i), c) for i, c in enumerate(history)] + [
        cost_row(date(2024, 3, 9), 300, meter=1), cost_row(date(2024, 3, 9), 200, meter=2)])
    rows = costs.anomalous_cost_data(star, NOW, "sub-1").collect()
    assert [r.actualCost for r in rows] == [300, 200]
    z = (500 - statistics.mean(history)) / statistics.stdev(history)
    assert rows[0].additionalInfo == f"Z-Score: {z:.2f}"


def test_rolling_band_of_constant_costs_is_skipped(spark):
    star = small_star(spark, cost=[cost_row(date(2024, 3, 1 + i), 50) for i in range(6)] + [cost_row(date(2024, 3, 9), 500)])
    assert costs.anomalous_cost_data(star, NOW).count() == 0
