"""Statistical anomaly detection per resource and per subscription."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl, ratio_or_zero, stamp
from ..functions.dates import days_before, first_day_from, months_before
from ..functions.severity import SEVERITIES, anomaly_type, confidence, severity_by_z, severity_by_z_and_impact
from ..star import Star
from .costs import cost_data

# Defaults of the detector and the names of its settings.
Z_THRESHOLD = 2.0
MIN_COST = 10.0
CONFIDENCE = 0.8
MIN_DAYS = 7
DETECTION_DAYS = 30


@dataclass(frozen=True)
class Thresholds:
    """Detector thresholds out of a settings mapping. The confidence threshold is read but nothing
    depends on it."""

    z: float = Z_THRESHOLD
    min_cost: float = MIN_COST
    confidence: float = CONFIDENCE

    @classmethod
    def from_settings(cls, settings: Mapping[str, str]) -> "Thresholds":
        return cls(
            float(settings.get("ZScoreThreshold") or Z_THRESHOLD),
            float(settings.get("MinCostThreshold") or MIN_COST),
            float(settings.get("ConfidenceThreshold") or CONFIDENCE),
        )


def population_stddev(column: Column) -> Column:
    """Aggregate; 0 for an empty input."""
    return F.coalesce(F.stddev_pop(column), F.lit(0.0))


def detect_anomalies(cost: DataFrame, z: float = Z_THRESHOLD, min_cost: float = MIN_COST) -> DataFrame:
    """Resource-days whose cost is ``z`` deviations away from the mean of the resource.

    ``cost`` holds resourceId, subscriptionId, date, actualCost (any number of rows per day).
    Mean and population deviation cover every day but the last; the last day is scored too.
    Resources with fewer than seven days or without variation give nothing. The windows see one
    row per resource and day, so their size is bounded by the calendar, not by the fact.
    """
    # Raw rows meet only a hash aggregate of sums; from there on everything is laid out by resource.
    daily = (
        cost.groupBy("resourceId", "date", "subscriptionId").agg(F.sum("actualCost").alias("actualCost"))
        .repartition("resourceId")
        .groupBy("resourceId", "date")
        .agg(F.sum("actualCost").alias("actualCost"), F.min("subscriptionId").alias("subscriptionId"))
    )
    resource = Window.partitionBy("resourceId")
    spent = F.col("actualCost").cast("double")
    history = F.when(F.col("date") < F.col("lastDate"), spent)
    scored = (
        daily.withColumn("lastDate", F.max("date").over(resource))
        .withColumn("days", F.count(F.lit(1)).over(resource))
        .withColumn("subscriptionId", F.min("subscriptionId").over(resource))
        .withColumn("mean", F.avg(history).over(resource))
        .withColumn("deviation", F.stddev_pop(history).over(resource))
        .filter((F.col("days") >= MIN_DAYS) & (F.col("deviation") > 0))
        .withColumn("zScore", (spent - F.col("mean")) / F.col("deviation"))
        .filter((F.abs("zScore") >= z) & (spent >= min_cost))
    )
    expected, score = F.col("mean"), F.col("zScore")
    return scored.select(
        "resourceId", "subscriptionId", "date", "actualCost",
        expected.alias("expectedCost"),
        (spent - expected).alias("variance"),
        (ratio_or_zero(spent - expected, expected) * 100).alias("variancePercentage"),
        "zScore",
        anomaly_type(spent, expected).alias("anomalyType"),
        severity_by_z_and_impact(score, spent, expected).alias("severity"),
        F.lit(True).alias("isAnomaly"),
        confidence(score).alias("confidence"),
    )


def result_records(anomalies: DataFrame, detected_at: datetime) -> DataFrame:
    """The published form: snake-case names and a detection stamp."""
    return anomalies.select(
        F.col("resourceId").alias("resource_id"),
        F.col("subscriptionId").alias("subscription_id"),
        F.col("date").cast("string").alias("date"),
        F.col("actualCost").alias("actual_cost"),
        F.col("expectedCost").alias("expected_cost"),
        "variance",
        F.col("variancePercentage").alias("variance_percentage"),
        F.col("zScore").alias("z_score"),
        F.col("anomalyType").alias("anomaly_type"),
        "severity",
        F.col("isAnomaly").alias("is_anomaly"),
        "confidence",
        F.lit(detected_at.isoformat()).alias("detected_at"),
    )


def severity_counts(anomalies: DataFrame) -> DataFrame:
    """Alert counts, one row per severity, 0 where there is none."""
    severity = F.col("severity")
    counts = anomalies.agg(*[F.count_if(severity == name).alias(name) for name in SEVERITIES])
    return counts.unpivot([], list(SEVERITIES), "severity", "alertCount")


def run_detection(
    star: Star, as_of: datetime, subscription_id: str | None = None, days_back: int = DETECTION_DAYS,
    z: float = Z_THRESHOLD, min_cost: float = MIN_COST,
) -> tuple[DataFrame, DataFrame]:
    """(cost rows analysed, anomalies found) for one subscription or, with ``None``, for all."""
    cost = cost_data(star, as_of, subscription_id, days_back)
    return cost, detect_anomalies(cost, z, min_cost)


def require_subscription(subscription_id: str | None) -> str:
    """A detection request must name its subscription."""
    if not subscription_id:
        raise ValueError("a detection request needs a subscription id")
    return subscription_id


def run_summary(cost: DataFrame, anomalies: DataFrame, days_back: int = DETECTION_DAYS) -> DataFrame:
    """One row: resources analysed, anomalies and alert counts (all 0 for empty input).

    The list of high-severity findings may be long; it is a frame of its own,
    :func:`high_severity`."""
    severity = F.col("severity")
    found = anomalies.agg(
        F.count(F.lit(1)).alias("anomalies_detected"),
        *[F.count_if(severity == name).alias(f"alerts_{name.lower()}") for name in SEVERITIES],
    )
    analysed = cost.agg(F.count_distinct("resourceId")).scalar()
    return found.select(
        F.lit(days_back).alias("analysis_period_days"),
        analysed.alias("total_resources_analyzed"), "anomalies_detected",
        *[f"alerts_{name.lower()}" for name in SEVERITIES],
    )


def high_severity(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("severity") == "High").select(
        F.col("resourceId").alias("resource_id"), "date",
        F.col("actualCost").alias("actual_cost"), F.col("expectedCost").alias("expected_cost"),
        F.col("variancePercentage").alias("variance_percentage"), F.col("zScore").alias("z_score"),
    )


def detect_cost_anomalies(
    star: Star, as_of: datetime, z: float = Z_THRESHOLD, min_cost: float = MIN_COST,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Rows to append to ``fact_anomaly_daily``: every subscription-day of the last 30 days,
    flagged or not, that ``existing`` does not hold yet at subscription level."""
    daily = (
        star.cost(["dateKey", "subscriptionKey", "actualCost"],
                  since=first_day_from(days_before(as_of, DETECTION_DAYS)))
        .groupBy("dateKey", "subscriptionKey")
        .agg(F.sum("actualCost").alias("actualCost"))
    )
    subscription = Window.partitionBy("subscriptionKey")
    spent = dbl("actualCost")
    scored = (
        daily.withColumn("expectedCost", F.avg(spent).over(subscription))
        .withColumn("deviation", F.stddev_samp(spent).over(subscription))
        .withColumn("costVariance", spent - F.col("expectedCost"))
        .withColumn("zScore", ratio_or_zero(F.col("costVariance"), F.col("deviation")))
    )
    if existing is not None:
        known = existing.filter(F.col("resourceKey").isNull()).select("dateKey", "subscriptionKey")
        scored = scored.join(known, ["dateKey", "subscriptionKey"], "left_anti")
    expected, score = F.col("expectedCost"), F.col("zScore")
    return scored.select(
        "dateKey", F.lit(None).cast("bigint").alias("resourceKey"), "subscriptionKey", "actualCost",
        "expectedCost", "costVariance",
        (ratio_or_zero(F.col("costVariance"), expected) * 100).alias("variancePercentage"),
        "zScore",
        anomaly_type(spent, expected).alias("anomalyType"),
        severity_by_z(score).alias("severity"),
        ((F.abs(score) >= z) & (spent >= min_cost)).alias("isAnomaly"),
        stamp(as_of).alias("detectionDate"),
    )


def with_previous_costs(
    anomalies: DataFrame, star: Star, as_of: datetime, days: int = DETECTION_DAYS
) -> DataFrame:
    """Fill the cost of the same subscription one day, one week and one month earlier.

    ``anomalies`` holds scored days of the last ``days`` days; history is read from a month before.
    """
    since = first_day_from(months_before(days_before(as_of, days), 1))
    history = (
        star.cost(["dateKey", "subscriptionKey", "actualCost"], since=since)
        .groupBy("dateKey", "subscriptionKey")
        .agg(F.sum("actualCost").alias("earlierCost"))
        .join(star.dim_date.select("dateKey", "date"), "dateKey")
        .select("subscriptionKey", F.col("date").alias("earlierDate"), "earlierCost")
    )
    filled = anomalies.join(star.dim_date.select("dateKey", "date"), "dateKey")
    for name, day in {
        "previousDayCost": F.date_sub("date", 1),
        "previousWeekCost": F.date_sub("date", 7),
        "previousMonthCost": F.add_months("date", -1),
    }.items():
        earlier = history.withColumnRenamed("earlierCost", name)
        filled = (
            filled.withColumn("earlierDate", day)
            .join(earlier, ["subscriptionKey", "earlierDate"], "left")
            .drop("earlierDate")
        )
    return filled.drop("date")
