"""Movers, attribution, stored roll-ups, drift and completeness of exports."""

from __future__ import annotations

import math
import os
from datetime import date, timedelta

import pytest
from stars import NOW, cost_row, small_star

from spendlens.functions.dates import date_key
from spendlens.operators import attribution, lattice, movers, quality
from spendlens.sources.exports import layout_drift


def day(number):
    return date(2024, 3, 15) - timedelta(days=number)


def test_effects_add_up_also_for_members_of_one_period(spark):
    cost = [
        cost_row(day(40), 100, usageQuantity=10), cost_row(day(5), 180, usageQuantity=12),  # dearer and more
        cost_row(day(40), 30, resource=2, usageQuantity=10),  # gone
        cost_row(day(3), 70, resource=3, usageQuantity=7),  # new
        cost_row(day(3), 50, resource=2, meter=2, usageQuantity=5),  # a new service
        cost_row(day(41), 9, resource=3, meter=2, usageQuantity=0), cost_row(day(4), 4, resource=3, meter=2, usageQuantity=0),  # fees
    ]
    star = small_star(spark, cost=cost)
    rows = movers.member_effects(star, NOW).collect()
    assert len(rows) == 5
    for r in rows:
        assert math.isclose(float(r.change), r.quantityEffect + r.mixEffect + r.priceEffect, abs_tol=1e-9)
    by = {(r.serviceName, r.resourceKey): r for r in rows}
    average = 130 / 20
    one = by["Compute", 1]
    assert math.isclose(one.quantityEffect, 2 * average) and math.isclose(one.mixEffect, 2 * (10 - average))
    assert math.isclose(one.priceEffect, 12 * (15 - 10))
    assert math.isclose(by["Compute", 2].quantityEffect + by["Compute", 2].mixEffect, -30) and by["Compute", 2].priceEffect == 0
    assert by["Compute", 3].mixEffect == 0
    totals = {r.serviceName: r for r in movers.movers_explained(star, NOW).collect()}
    assert (totals["Compute"].membersCome, totals["Compute"].membersGone) == (1, 1)
    assert float(totals["Storage"].change) == 45


def test_the_cells_that_explain_a_flagged_day(spark):
    cost = [cost_row(day(n), 10, resource=r, meter=m) for n in range(10) for r in (1, 2) for m in (1, 2)]
    cost += [cost_row(day(0), 500, resource=2, meter=1), cost_row(day(0), 30, resource=1, meter=2)]
    resources = [{"resourceKey": k, "resourceId": f"/res/{k}", "app": f"app-{k}", "isCurrent": True} for k in (1, 2)]
    star = small_star(spark, cost=cost, resources=resources)
    flagged = spark.createDataFrame([(date_key(day(0)), 1, True), (date_key(day(1)), 1, False)], "dateKey int, subscriptionKey int, isAnomaly boolean")
    rows = attribution.variance_by_cell(star, flagged, NOW).collect()
    assert [(r.serviceName, r.tagValue, r.rank) for r in rows] == [("Compute", "app-2", 1)]
    assert math.isclose(rows[0].variance, 510 - 60) and rows[0].share > 0.8
    more = attribution.variance_by_cell(star, flagged, NOW, explained=0.999).collect()
    assert {(r.serviceName, r.tagValue) for r in more} == {("Compute", "app-2"), ("Storage", "app-1")}
    assert attribution.variance_by_cell(star, flagged.filter("NOT isAnomaly"), NOW).collect() == []


def test_a_drill_takes_the_coarsest_level_that_suffices(spark, tmp_path):
    cost = [cost_row(date(2024, m, d), 2, resource=r, subscription=s) for m in (1, 2) for d in (1, 9) for r in (1, 2) for s in (1, 2)]
    stored = lattice.Lattice(spark, str(tmp_path))
    stored.build(small_star(spark, cost=cost))
    assert lattice.Lattice.level_for(["businessUnit"]) == "year_unit"
    assert lattice.Lattice.level_for(["month", "subscriptionId"]) == "month_subscription"
    assert lattice.Lattice.level_for(["year"], exact=True) == "day_resource"
    with pytest.raises(ValueError):
        lattice.Lattice.level_for(["team"])
    read = lambda *columns, exact=False: sorted((*[r[c] for c in columns], int(r.cost), r.costRows, r.resources) for r in stored.drill(columns, exact).collect())
    assert read("month", "subscriptionId") == read("month", "subscriptionId", exact=True) == [
        (m, f"sub-{s}", 8, 4, 2) for m in (1, 2) for s in (1, 2)]
    assert read("year") == [(2024, 32, 16, 2)]
    # February comes again with other amounts; January stays as stored
    again = [cost_row(date(2024, 2, 1), 5), cost_row(date(2024, 1, 1), 99)]
    stored.build(small_star(spark, cost=again), since=date(2024, 2, 1))
    assert read("month") == [(1, 16, 8, 2), (2, 5, 1, 1)] and read("year") == [(2024, 21, 9, 2)]


def test_drift_of_each_export(spark, tmp_path):
    def write(name, time, header, *lines):
        os.makedirs(tmp_path / name)
        (tmp_path / name / "p.csv").write_text("\n".join([header, *lines]))
        os.utime(tmp_path / name / "p.csv", (time, time))

    write("a", 1000, "Date,MeterId,Tags,Quantity", "2024-01-01,m,x,1.5")
    write("b", 2000, "Date,MeterId,Quantity,MeterId", "2024-01-02,m,n/a,m", "someday,m,,m")
    write("c", 3000, "Date,MeterId,Tags,Quantity,Extra", '2024-01-03,"m",x,2,e')
    rows = layout_drift(spark, str(tmp_path), ["Date", "MeterId", "Tags"]).collect()
    assert sorted((r.exportFolder[-1], r.column, r.problem, r.rows) for r in rows) == sorted([
        ("b", "Tags", "missing", None), ("b", "Tags", "disappeared", None), ("b", "MeterId", "repeated", 2),
        ("b", "Quantity", "retyped", 1), ("b", "Date", "retyped", 1), ("c", "Tags", "appeared", None),
        ("c", "Extra", "appeared", None), ("c", "Extra", "unexpected", None)])


def test_days_that_an_account_did_not_deliver(spark):
    row = lambda account, d, start: (account, d, start, date(start.year, start.month, 28))
    rows = [row("a", date(2024, 1, n), date(2024, 1, 1)) for n in range(1, 29) if n not in (3, 4)]
    rows += [row("a", date(2024, 2, 1), date(2024, 2, 1)), row("a", date(2024, 2, 5), date(2024, 2, 1)), row("b", date(2024, 1, 1), date(2024, 1, 1))]
    found = quality.account_completeness(spark.createDataFrame(
        rows, "BillingAccountId string, Date date, BillingPeriodStartDate date, BillingPeriodEndDate date")).collect()
    assert sorted((r.BillingAccountId, r.BillingPeriodStartDate.month, r.expectedDays, r.deliveredDays, r.missingDays) for r in found) == [
        ("a", 1, 28, 26, 2), ("a", 2, 5, 2, 3), ("b", 1, 1, 1, 0)]
