"""Views over advisor recommendations and raw metric samples."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.advice import monthly_savings, recommendation_category, recommendation_priority
from ..functions.columns import dbl, safe_divide
from ..functions.dates import days_before, first_day_from, last_day_until
from ..functions.metrics import CPU, FREE_MEMORY, resource_type, utilization_percentage
from ..functions.quantiles import approximate_percentiles, percentiles_of_counts
from ..functions.staging import staged
from ..star import Star
from .kpis import utilization_status

# Windows and limits.
METRIC_DAYS = 30
SAMPLE_DAYS = 7
SAMPLE_MAX_CPU = 20
SAMPLE_MIN_ROWS = 5
MEMORY_HIGH = 0.8
MEMORY_LOW = 0.2


def cost_advisor_recommendations(star: Star) -> DataFrame:
    """Active cost recommendations with savings, category and priority read from their text."""
    benefits = F.col("potentialBenefits")
    return (
        star.raw_advisor_recommendations
        .filter((F.col("category") == "Cost") & (F.col("status") == "Active"))
        .select(
            "id", "resourceId", "resourceName", "resourceType", "resourceGroup", "subscriptionId",
            "impact", "recommendationTypeId", "shortDescription", "longDescription",
            "potentialBenefits", "actions", "remediation", "createdTime", "lastUpdated", "status",
            monthly_savings(benefits).alias("potentialMonthlySavings"),
            recommendation_category(F.col("recommendationTypeId")).alias("recommendationCategory"),
            recommendation_priority(F.col("impact"), benefits).alias("priority"),
        )
    )


def resource_utilization_metrics(star: Star, as_of: datetime) -> DataFrame:
    """Samples of the last 30 days with a utilization percentage and a readable resource type."""
    return star.metrics(since=days_before(as_of, METRIC_DAYS)).select(
        "resourceId", "subscriptionId", "resourceGroup", "location", "metricName", "metricNamespace",
        "startTime", "endTime", "timeGrain", "aggregationType", "metricValue", "unit",
        utilization_percentage().alias("utilizationPercentage"),
        resource_type(F.col("metricNamespace")).alias("resourceType"),
    )


def daily_metrics_summary(star: Star, as_of: datetime, approximate: bool = False) -> DataFrame:
    """Day statistics per resource and metric. The percentiles cover the day, resource and metric,
    whichever group or namespace a sample was filed under; ``approximate`` takes sketches.

    The samples are read once: equal values are counted, and both the statistics and the exact
    percentiles come from these counts."""
    samples = star.metrics(since=days_before(as_of, METRIC_DAYS)).select(
        F.to_date("startTime").alias("metricDate"), "resourceId", "subscriptionId", "resourceGroup",
        "metricName", "metricNamespace", "metricValue",
    )
    series = ["metricDate", "resourceId", "metricName"]
    filed, wanted = [*series, "subscriptionId", "resourceGroup", "metricNamespace"], {"p50Value": 0.50, "p95Value": 0.95}
    counts = samples.groupBy(*filed, "metricValue").agg(F.count(F.lit(1)).alias("rows"))
    if approximate:
        quantiles = approximate_percentiles(samples, series, "metricValue", wanted)
    else:
        counts = staged(counts, "metric-counts")
        quantiles = percentiles_of_counts(counts, series, "metricValue", "rows", wanted)
    groups = counts.groupBy(*filed).agg(
        F.sum(F.col("metricValue") * F.col("rows")).alias("sumValue"), F.max("metricValue").alias("maxValue"),
        F.min("metricValue").alias("minValue"), F.sum("rows").alias("sampleCount"),
    )
    average, top = F.col("avgValue"), dbl("maxValue")
    memory_status = (
        F.when(average > top * MEMORY_HIGH, "Underutilized")
        .when(average < top * MEMORY_LOW, "Overutilized")
        .otherwise("Optimal")
    )
    metric = F.col("metricName")
    return (
        groups.withColumn("avgValue", safe_divide(F.col("sumValue"), F.col("sampleCount")))
        .join(quantiles, series)
        .select(
            *series, "subscriptionId", "resourceGroup", "metricNamespace", "avgValue", "maxValue",
            "minValue", "sampleCount", "p50Value", "p95Value",
            F.when(metric == CPU, utilization_status(average))
            .when(metric == FREE_MEMORY, memory_status)
            .otherwise("Unknown").alias("utilizationStatus"),
        )
    )


def resource_utilization_sample(star: Star, as_of: datetime) -> DataFrame:
    """Little-used resources of the last seven days, costliest first.

    Defined over utilization joined to cost on the resource alone, so every utilization day meets
    every cost row of the resource. The product of both counts gives the same figures without
    building a single pair.
    """
    used = (
        star.utilization(since=first_day_from(days_before(as_of, SAMPLE_DAYS)), until=last_day_until(as_of))
        .join(star.dim_date.select("dateKey"), "dateKey")
        .groupBy("resourceKey")
        .agg(F.sum(dbl("avgCpuPercentage")).alias("cpu"), F.count("avgCpuPercentage").alias("cpuDays"),
             F.count(F.lit(1)).alias("usedDays"))
    )
    spent = star.cost(["resourceKey", "actualCost"]).groupBy("resourceKey").agg(
        F.sum("actualCost").alias("cost"), F.count(F.lit(1)).alias("costRows")
    )
    resources = star.dim_resource.select("resourceKey", "resourceId", "resourceName", "resourceType")
    keyed = used.join(spent, "resourceKey").join(resources, "resourceKey")
    cost_rows = F.col("costRows")
    return (
        keyed.groupBy("resourceId", "resourceName", "resourceType")
        .agg(
            safe_divide(F.sum(F.col("cpu") * cost_rows), F.sum(F.col("cpuDays") * cost_rows)).alias("avg_cpu"),
            F.sum(F.col("usedDays") * cost_rows).alias("days_measured"),
            F.sum(F.col("cost") * F.col("usedDays")).alias("total_cost"),
        )
        .filter((F.col("avg_cpu") < SAMPLE_MAX_CPU) & (F.col("days_measured") >= SAMPLE_MIN_ROWS))
        .orderBy(F.desc("total_cost"), "resourceId")
    )
