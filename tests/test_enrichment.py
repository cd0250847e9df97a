"""Reading advisor texts and metric samples."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from stars import NOW, by, cost_row, sample, small_star

from spendlens.functions.advice import monthly_savings, recommendation_category, recommendation_priority
from spendlens.operators import enrichment, rollup


@pytest.mark.parametrize("text, amount, priority", [
    ("Save $120.50 per month", 120.5, "Low"),   # the strict reading sees '120.50 per'
    ("$1,234", 1.0, "Low"),
    ("$ 5", None, "Low"),
    ("save $900.00", 900.0, "High"),
    ("no amount", 0.0, "Low"),
    ("$1500.00   ", 1500.0, "High"),
    ("$150", 150.0, "Medium"),
    ("$12.3.4 x", None, "Low"),
])
def test_amounts(spark, text, amount, priority):
    row = spark.createDataFrame([(text,)], "b string").select(
        monthly_savings(F.col("b")).alias("a"), recommendation_priority(F.lit("Low"), F.col("b")).alias("p")).first()
    assert (None if row.a is None else float(row.a)) == amount
    assert row.p == priority


@pytest.mark.parametrize("impact, text, priority", [
    ("High", "$1500.00   ", "Critical"), ("High", "none", "High"), ("Medium", "none", "Medium"), ("Medium", "$600", "High"),
])
def test_priority_by_impact(spark, impact, text, priority):
    assert spark.range(1).select(recommendation_priority(F.lit(impact), F.lit(text))).first()[0] == priority


@pytest.mark.parametrize("type_id, category", [
    ("IdleRightSize", "Idle Resources"), ("VmRightSize", "Right Size"), ("ReservedVm", "Reserved Instances"),
    ("Spot", "Spot Instances"), ("Unattached", "Unattached Resources"), ("Premium", "Premium Tier Optimization"), ("x", "Other"),
])
def test_category(spark, type_id, category):
    assert spark.range(1).select(recommendation_category(F.lit(type_id))).first()[0] == category


def memory(dimensions, value=300):
    return sample("/res/1", "Available Memory Bytes", value, unit="Bytes", dimensions=dimensions)


@pytest.mark.parametrize("dimensions, expected", [
    ('{"TotalMemory": 1200}', 75.0), ('{"TotalMemory": "1200"}', 75.0), ("{}", None), ('{"TotalMemory": 0}', None),
    ('{"TotalMemory": "much"}', None), ("{broken", None), (None, None),
])
def test_memory_share(spark, dimensions, expected):
    star = small_star(spark, metrics=[memory(dimensions)])
    assert enrichment.resource_utilization_metrics(star, NOW).first().utilizationPercentage == expected


def test_memory_in_other_units_is_raw(spark):
    star = small_star(spark, metrics=[sample("/res/1", "Available Memory Bytes", 7, unit="Megabytes")])
    row = enrichment.resource_utilization_metrics(star, NOW).first()
    assert (row.utilizationPercentage, row.resourceType) == (7.0, "App Service")


def test_percentiles_cover_all_groups_of_a_series(spark):
    star = small_star(spark, metrics=[
        sample("/res/1", "Percentage CPU", v, metricNamespace=ns) for v, ns in ((10, "a"), (20, "a"), (90, "b"))])
    rows = by(enrichment.daily_metrics_summary(star, NOW), "metricNamespace")
    assert (rows["a"].avgValue, rows["a"].sampleCount, rows["a"].utilizationStatus) == (15.0, 2, "Underutilized")
    assert rows["b"].utilizationStatus == "Overutilized"
    assert {r.p50Value for r in rows.values()} == {20.0}
    assert rows["a"].p95Value == pytest.approx(83.0)
    assert {r.p95Value for r in enrichment.daily_metrics_summary(star, NOW, approximate=True).collect()} == {90.0}


def test_rollup(spark):
    late = datetime(2024, 3, 10, 23)
    star = small_star(spark, metrics=[
        sample("/res/1", "Percentage CPU", 3, grain="PT1M"), sample("/res/1", "Percentage CPU", 5, grain="PT5M"),
        sample("/res/1", "Disk Reads", 10, grain="PT1H", kind="Total"), sample("/res/1", "Disk Reads", 99, kind="Average"),
        sample("/res/1", "Network In", 4, kind="Total"), memory('{"TotalMemory": 1200}'), memory('{"TotalMemory": 400}'),
        sample("/res/2", "Percentage CPU", 50, start=late, grain="P1D"),
        sample("/gone", "Percentage CPU", 50), sample("/res/2", "Percentage CPU", 1, start=datetime(2024, 3, 1)),
    ])
    rows = by(rollup.aggregate_daily_metrics(star, NOW), "resourceId")
    one = rows["/res/1"]
    assert (one.dateKey, one.resourceKey) == (20240314, 1)
    assert (one.avgCpuPercentage, one.maxCpuPercentage, one.idlePercentage) == (4.0, 5.0, 95.0)
    assert (one.avgMemoryPercentage, one.maxMemoryPercentage) == (50.0, 75.0)
    assert (one.avgDiskIOPS, one.avgNetworkIOPS, one.availabilityPercentage) == (10.0, 4.0, 95.0)
    assert one.uptimeHours == pytest.approx(2 * 5 / 60)  # the largest grain code as text is PT5M
    assert (rows["/res/2"].uptimeHours, rows["/res/2"].idlePercentage) == (1.0, 10.0)
    assert rows["/gone"].resourceKey is None and len(rows) == 3


def test_utilization_sample_equals_the_joined_form(spark):
    use = [{"dateKey": 20240309 + i, "resourceKey": k, "resourceId": f"/res/{k}", "avgCpuPercentage": c}
           for k, cpus in ((1, [5, 7, None]), (2, [10, 60])) for i, c in enumerate(cpus)]
    star = small_star(spark, utilization=use, cost=[cost_row(date(2024, 1, d), 10 * d, resource=r) for d in (1, 2) for r in (1, 2)])
    joined = (
        star.fact_utilization_daily.alias("u").join(star.fact_cost_daily.alias("f"), "resourceKey")
        .groupBy("resourceKey").agg(F.avg("avgCpuPercentage").alias("cpu"), F.count("*").alias("n"), F.sum("actualCost").alias("c"))
        .filter("cpu < 20 and n >= 5").collect())
    found = enrichment.resource_utilization_sample(star, NOW).collect()
    assert [(float(r.cpu), r.n, r.c) for r in joined] == [(r.avg_cpu, r.days_measured, r.total_cost) for r in found] == [(6.0, 6, 90)]
