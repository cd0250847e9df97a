"""Versions, moments, seasonal forecasts, commitments, idle runs, crossings."""

from __future__ import annotations

import math
import random
import statistics
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from stars import NOW, cost_row, small_star

from spendlens.functions.dates import date_key
from spendlens.operators import commitment, forecast, idle, moments, versions
from spendlens.plans.incremental import DailyMoments
from spendlens.streaming.crossings import crossings, run_crossings

SNAPSHOT = "resourceId string, seenOn date, loadedOn int, deleted boolean, team string"


def day(number):
    return date(2024, 1, 1) + timedelta(days=number)


def valid_team(snapshots, resource, on):
    """The last state seen on or before a day, by going through all snapshots."""
    seen = [(s[1], s[2], s[3], s[4]) for s in snapshots if s[0] == resource and s[1] <= on]
    if not seen:
        return None
    last = max(seen, key=lambda s: (s[0], s[1]))
    return None if last[2] else last[3]


@pytest.mark.parametrize("seed", range(3))
def test_a_fact_gets_the_version_of_its_day(spark, seed):
    rng = random.Random(seed)
    snapshots = [(f"r{rng.randrange(4)}", day(rng.randrange(40)), n, rng.random() < 0.15, rng.choice("abc")) for n in range(60)]
    facts = [(rng.choice(["r0", "r0", "r0", "r1", "r2", "r3", "unknown", None]), day(rng.randrange(-3, 45)), n) for n in range(400)]
    facts += [("r0", None, -1)]
    rng.shuffle(snapshots)  # the order of arrival does not matter
    held = versions.versions_of(spark.createDataFrame(snapshots, SNAPSHOT), ["team"])
    rows = versions.with_version(spark.createDataFrame(facts, "resourceId string, date date, n int"), held, ["team"]).collect()
    assert len(rows) == len(facts)
    expected = {n: valid_team(snapshots, r, d) if r and d else None for r, d, n in facts}
    assert {r.n: r.team for r in rows} == expected
    ordered = sorted((r.resourceId, r.validFrom, r.validTo, r.team) for r in held.fillna({}).collect() if r.validTo)
    assert all(start < end for _, start, end, _ in ordered)


def test_a_late_snapshot_splits_a_version(spark):
    first = [("r", day(0), 1, False, "a"), ("r", day(30), 2, False, "a")]
    late = [*first, ("r", day(10), 3, False, "b"), ("r", day(10), 3, False, "b")]
    spans = lambda rows: sorted((r.validFrom, r.validTo, r.team) for r in versions.versions_of(spark.createDataFrame(rows, SNAPSHOT), ["team"]).collect())
    assert spans(first) == [(day(0), None, "a")]
    assert sorted(spans(late), key=repr) == sorted([(day(0), day(10), "a"), (day(10), day(30), "b"), (day(30), None, "a")], key=repr)
    assert spans([]) == []


def test_moments_merge_and_part(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.choice([0, 1]), rng.uniform(-5, 1000)) for _ in range(200)] + [("only", 0, 3.0), ("late", 1, None)]
    df = spark.createDataFrame(rows, "member string, part int, x double")
    whole, one, two = (moments.moments_of(d, ["member"], "x") for d in (df, df.filter("part = 0"), df.filter("part = 1")))
    read = lambda d: {r.member: (r.days, round(r.mean, 6), round(r.squares, 4)) for r in d.collect()}
    assert read(moments.merged(one, two, ["member"])) == read(whole) == read(moments.merged(two, one, ["member"]))
    left = read(moments.without(whole, two, ["member"]))
    assert {m: v for m, v in left.items() if v[0]} == read(one)
    values = [x for m, _, x in rows if m == "a"]
    spread = {r.member: r.s for r in whole.select("member", moments.deviation().alias("s")).collect()}
    assert math.isclose(spread["a"], statistics.pstdev(values)) and spread["late"] is None


def test_daily_runs_equal_a_full_computation_and_may_be_repeated(spark, tmp_path):
    rng = random.Random(2)
    values = {(n, s): rng.choice([50, 60, 70, 900 if n > 9 else 55]) for n in range(14) for s in (1, 2) if s == 1 or n % 3}
    star = small_star(spark, cost=[cost_row(day(n), v / 2, subscription=s) for (n, s), v in values.items() for _ in range(2)])
    store = DailyMoments(spark, str(tmp_path / "m"))
    for n in range(14):
        store.apply(star, day(n), day(n - 1) if n else None)
    store.apply(star, day(13), day(12))
    got = {(r.dateKey, r.subscriptionKey): r for r in store.scores().collect()}
    expected = {}
    for (n, s), v in values.items():
        earlier = [values[m, s] for m in range(n) if (m, s) in values]
        if earlier:
            spread = statistics.pstdev(earlier)
            expected[date_key(day(n)), s] = (statistics.mean(earlier), (v - statistics.mean(earlier)) / spread if spread else 0.0)
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[k].expectedCost, m) and math.isclose(got[k].zScore, z, abs_tol=1e-9) for k, (m, z) in expected.items())
    kinds = {(r.anomalyType, r.severity, r.isAnomaly) for r in got.values()}
    assert {t for t, _, _ in kinds} == {"Spike", "Drop"} and len({s for _, s, _ in kinds}) == 3
    final = {r.subscriptionKey: r for r in store.moments(day(13)).collect()}
    assert final[2].days == sum(s == 2 for _, s in values)


def test_an_exact_weekly_pattern_is_forecast_exactly(spark):
    cost = [cost_row(date(2024, 3, 15) - timedelta(days=n), 500 - n + 40 * ((date(2024, 3, 15) - timedelta(days=n)).weekday() == 6))
            for n in range(70)]
    cost += [cost_row(date(2024, 3, 15), 5, subscription=2)]  # one day: no forecast
    star = small_star(spark, cost=cost)
    rows = {r.forecastHorizonDays: r for r in forecast.seasonal_forecast(star, NOW, history_days=42, horizons=(1, 2, 30)).collect()}
    assert set(rows) == {1, 2, 30}
    for horizon, r in rows.items():
        target = date(2024, 3, 15) + timedelta(days=horizon)
        expected = 500 + horizon + 40 * (target.weekday() == 6)
        assert r.dateKey == date_key(target) and math.isclose(r.forecastedCost, expected, rel_tol=1e-9)
        assert math.isclose(r.modelAccuracy, 100.0) and abs(r.confidenceIntervalUpper - expected) < 1e-3
    tested = forecast.backtest(star, NOW, history_days=42).collect()
    assert len(tested) == 4 and all(r.testedDays == 7 for r in tested)


def test_the_purchase_that_saves_most(spark):
    rng = random.Random(3)
    demand = {n: rng.choice([0, 0, 10, 20, 35, 50]) for n in range(30)}
    cost = [cost_row(date(2024, 3, 15) - timedelta(days=n), v) for n, v in demand.items() if v]
    cost += [cost_row(date(2024, 3, 15), 100, meter=2), cost_row(date(2024, 3, 14), 9, isReservationCharge=True)]
    rows = {(r.serviceName, r.term): r for r in commitment.purchase_quantity(
        small_star(spark, cost=cost), NOW, days=30, price_percent={"flat": 60, "cheap": 10, "dear": 100}).collect()}
    for term, percent in (("flat", 60), ("cheap", 10), ("dear", 100)):
        gain = lambda c: sum(min(v, c) for v in demand.values()) * 100 - 30 * c * percent
        best = max(sorted(set(demand.values()) | {0}), key=lambda c: (gain(c), -c))
        r = rows["Compute", term]
        assert (int(r.dailyCommitment), r.saving) == (best, Decimal(gain(best)) / 100)
        assert r.wastedAmount == 30 * best - sum(min(v, best) for v in demand.values())
    assert rows["Storage", "flat"].dailyCommitment == 0 and rows["Storage", "flat"].utilizationPercentage is None


def test_idle_runs_end_where_a_day_is_missing(spark):
    used = lambda n, idle, resource=1: {"dateKey": date_key(day(n)), "resourceKey": resource, "idlePercentage": idle}
    star = small_star(spark, cost=[cost_row(day(n), 2) for n in range(12)], utilization=[
        *[used(n, 95) for n in (0, 1, 2, 4, 5, 8, 9, 10, 11)], used(3, 10), *[used(n, 80, 2) for n in (0, 2, 4)], *[used(n, 95, 3) for n in range(5)]])
    rows = idle.idle_runs(star, min_days=3).collect()
    assert sorted((r.resourceId, r.firstDay, r.lastDay, r.idleDays, int(r.cost)) for r in rows) == [
        ("/res/1", day(0), day(2), 3, 6), ("/res/1", day(8), day(11), 4, 8)]
    assert sorted(r.idleDays for r in idle.idle_runs(star, min_days=2).collect()) == [2, 3, 4]


def test_each_threshold_is_announced_once_over_restarts(spark, tmp_path):
    budgets = spark.createDataFrame([("s", 2024, 1, Decimal(100)), ("t", 2024, 1, Decimal(0))], "subscriptionId string, year int, month int, budgetAmount decimal(18,2)")
    fields, folder = "rowId string, subscriptionId string, year int, month int, cost decimal(18,2)", str(tmp_path / "x")

    def deliver(*rows):
        spark.createDataFrame([(i, s, 2024, m, Decimal(c)) for i, s, m, c in rows], fields).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(fields).parquet(f"{folder}/in")
        run_crossings(stream, budgets, folder).awaitTermination()
        return [(r.threshold, int(r.spent)) for r in crossings(spark, folder).filter("subscriptionId = 's'").orderBy("threshold").collect()]

    assert deliver(("a", "s", 1, 49), ("b", "t", 1, 500), ("c", "u", 1, 7)) == []
    assert deliver(("a", "s", 1, 49), ("d", "s", 1, 1)) == [(50, 50)]  # the first row repeated
    assert deliver(("e", "s", 1, 45), ("f", "s", 2, 99)) == [(50, 50), (75, 95), (90, 95)]
    assert deliver(("g", "s", 1, -60)) == [(50, 50), (75, 95), (90, 95)]
    assert deliver(("h", "s", 1, 70)) == [(50, 50), (75, 95), (90, 95), (100, 105)]
    assert crossings(spark, folder).filter("subscriptionId <> 's'").count() == 0
    assert crossings(spark, str(tmp_path / "none")).count() == 0
