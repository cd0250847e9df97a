"""Detector scenarios on hand-made series."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from spendlens.functions.severity import severity_by_z_and_impact
from spendlens.operators import anomaly

FIRST = date(2024, 1, 1)
# Fixed values around 100, one month.
NORMAL = [98, 105, 93, 107, 101, 95, 109, 92, 100, 104, 97, 106, 94, 103, 99,
          108, 91, 102, 96, 105, 100, 93, 107, 98, 104, 95, 101, 106, 97, 103]


def series(spark, costs, resource="/res/a", subscription="sub-1"):
    rows = [(resource, subscription, FIRST + timedelta(days=i), float(c)) for i, c in enumerate(costs)]
    return spark.createDataFrame(rows, "resourceId string, subscriptionId string, date date, cost double").select(
        "resourceId", "subscriptionId", "date", F.col("cost").cast("decimal(18,2)").alias("actualCost"))


def changed(costs, day, value):
    return [value if i == day else c for i, c in enumerate(costs)]


def test_normal_series_gives_nothing(spark):
    assert anomaly.detect_anomalies(series(spark, NORMAL)).count() == 0


def test_spike_is_high(spark):
    found = anomaly.detect_anomalies(series(spark, changed(NORMAL, 14, 1000))).collect()
    assert [(r.date, r.anomalyType, r.severity) for r in found] == [(FIRST + timedelta(days=14), "Spike", "High")]
    assert found[0].confidence == 1.0 and found[0].isAnomaly


def test_drop(spark):
    found = anomaly.detect_anomalies(series(spark, changed(NORMAL, 9, 10))).collect()
    assert [r.anomalyType for r in found] == ["Drop"]


def test_cost_limit_is_inclusive(spark):
    assert anomaly.detect_anomalies(series(spark, changed(NORMAL, 9, 10)), min_cost=10.01).count() == 0


def test_last_day_is_scored_but_not_learned(spark):
    found = anomaly.detect_anomalies(series(spark, [*NORMAL, 5000])).collect()
    assert [r.date for r in found] == [FIRST + timedelta(days=30)]
    assert found[0].expectedCost == pytest.approx(sum(NORMAL) / 30)


def test_a_week_is_needed(spark):
    assert anomaly.detect_anomalies(series(spark, [100, 101, 99, 100, 102, 900])).count() == 0
    assert anomaly.detect_anomalies(series(spark, [100, 101, 99, 100, 102, 100, 900])).count() == 1


def test_constant_history_is_skipped(spark):
    assert anomaly.detect_anomalies(series(spark, [0.1] * 30 + [900])).count() == 0


def test_rows_of_a_day_are_added_up(spark):
    twice = series(spark, changed(NORMAL, 14, 1000))
    found = anomaly.detect_anomalies(twice.unionAll(twice)).collect()
    assert [float(r.actualCost) for r in found] == [2000.0]


@pytest.mark.parametrize("z, actual, expected, severity", [
    (3.5, 1500.0, 100.0, "High"), (2.5, 500.0, 100.0, "Medium"), (1.5, 150.0, 100.0, "Low"),
    (3.0, 100.0, 100.0, "High"), (2.0, 100.0, 100.0, "Medium"), (0.0, 1100.0, 100.0, "High"),
    (0.0, 200.0, 100.0, "Medium"), (-3.0, 0.0, 1.0, "High"),
])
def test_severity(spark, z, actual, expected, severity):
    column = severity_by_z_and_impact(F.lit(z), F.lit(actual), F.lit(expected))
    assert spark.range(1).select(column).first()[0] == severity


def test_population_deviation(spark):
    values = [100, 105, 95, 110, 90, 105, 100, 95, 110, 100]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert df.agg(anomaly.population_stddev(F.col("v"))).first()[0] == pytest.approx(6.2450, abs=1e-4)
    assert df.filter("false").agg(anomaly.population_stddev(F.col("v"))).first()[0] == 0.0


def test_severity_counts_are_complete(spark):
    found = spark.createDataFrame([("High",), ("Medium",), ("Medium",)], "severity string")
    assert {r.severity: r.alertCount for r in anomaly.severity_counts(found).collect()} == {
        "High": 1, "Medium": 2, "Low": 0}
    assert {r.alertCount for r in anomaly.severity_counts(found.filter("false")).collect()} == {0}


def test_summary_of_nothing(spark):
    empty = series(spark, [])
    row = anomaly.run_summary(empty, anomaly.detect_anomalies(empty)).first()
    assert (row.total_resources_analyzed, row.anomalies_detected, row.alerts_high) == (0, 0, 0)


def test_thresholds_come_from_settings():
    assert anomaly.Thresholds.from_settings({}) == anomaly.Thresholds(2.0, 10.0, 0.8)
    assert anomaly.Thresholds.from_settings({"ZScoreThreshold": "3", "MinCostThreshold": "0.5"}) == anomaly.Thresholds(3.0, 0.5)


def test_subscription_is_required():
    with pytest.raises(ValueError):
        anomaly.require_subscription("")
