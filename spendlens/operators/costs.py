"""Cost lookups by subscription, resource and date range.

``subscription_id`` and ``resource_id`` select one member; ``None`` means every member.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import text
from ..functions.dates import days_before, first_day_from, last_day_until
from ..star import Star

# Tag names and the resource columns they come from.
TAG_COLUMNS = {
    "Environment": "env",
    "Application": "app",
    "Team": "team",
    "CostCenter": "costCenter",
    "BusinessUnit": "businessUnit",
    "Project": "project",
    "Service": "service",
    "Compliance": "compliance",
    "DataSensitivity": "dataSensitivity",
}

# Rolling window and limits of the rolling z-score.
ROLLING_ROWS = 6
ROLLING_Z = 2.0
ROLLING_MIN_COST = 10


def _iso(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _subscription(star: Star, subscription_id: str | None) -> DataFrame:
    keys = star.dim_subscription
    if subscription_id is not None:
        keys = keys.filter(F.col("subscriptionId") == subscription_id)
    return keys.select("subscriptionKey")


def _range(start: date | datetime, end: date | datetime) -> dict:
    return {"since": first_day_from(start), "until": last_day_until(end)}


def cost_data(star: Star, as_of: datetime, subscription_id: str | None = None, days_back: int = 30) -> DataFrame:
    """The last ``days_back`` days of :func:`cost_data_by_range`."""
    return cost_data_by_range(star, days_before(as_of, days_back), as_of, subscription_id)


def cost_data_by_range(
    star: Star, start: date | datetime, end: date | datetime, subscription_id: str | None = None
) -> DataFrame:
    """Cost rows with resource, meter and tags; newest day first, then highest cost."""
    cost = star.cost(
        ["dateKey", "resourceKey", "meterKey", "subscriptionKey", "actualCost", "amortizedCost", "costInUSD",
         "usageQuantity", "effectivePrice", "isReservationCharge", "isSavingsPlanCharge", "chargeType",
         "additionalInfo"],
        **_range(start, end),
    )
    resources = star.current_resources(
        "resourceId", "resourceName", "resourceType", "resourceGroupName", "location",
        "subscriptionId", "subscriptionName", *TAG_COLUMNS.values(),
    )
    meters = star.dim_meter.select(
        "meterKey", "meterCategory", "meterSubCategory", "serviceName", "serviceTier", "unitOfMeasure"
    )
    days = star.dim_date.select("dateKey", "date", "billingPeriodStart", "billingPeriodEnd")
    rows = (
        cost.join(_subscription(star, subscription_id), "subscriptionKey")
        .join(days, "dateKey")
        .join(resources, "resourceKey")
        .join(meters, "meterKey")
    )
    tags = F.create_map(*[e for name, column in TAG_COLUMNS.items() for e in (F.lit(name), text(column))])
    return (
        rows.orderBy(F.desc("date"), F.desc("actualCost"), "resourceKey", "meterKey", "amortizedCost", "usageQuantity")
        .select(
            "resourceId", "resourceName", "resourceType", "subscriptionId", "subscriptionName",
            _iso("date"), "actualCost", "amortizedCost", "costInUSD", "usageQuantity", "effectivePrice",
            "meterCategory", text("meterSubCategory").alias("meterSubCategory"), "serviceName",
            text("serviceTier").alias("serviceTier"), "unitOfMeasure", text("location").alias("location"),
            text("resourceGroupName").alias("resourceGroup"),
            _iso("billingPeriodStart").alias("billingPeriodStartDate"),
            _iso("billingPeriodEnd").alias("billingPeriodEndDate"),
            text("chargeType").alias("chargeType"), "isReservationCharge", "isSavingsPlanCharge",
            text("additionalInfo").alias("additionalInfo"), tags.alias("tags"),
        )
    )


def cost_data_by_resource(
    star: Star, as_of: datetime, resource_id: str | None = None, days_back: int = 30
) -> DataFrame:
    """Cost rows of one resource over the last days, newest first."""
    resources = star.current_resources("resourceId", "resourceName", "resourceType")
    if resource_id is not None:
        resources = resources.filter(F.col("resourceId") == resource_id)
    cost = star.cost(
        ["dateKey", "resourceKey", "meterKey", "actualCost", "amortizedCost", "costInUSD", "usageQuantity",
         "effectivePrice"],
        **_range(days_before(as_of, days_back), as_of),
    )
    rows = (
        cost.join(resources, "resourceKey")
        .join(star.dim_date.select("dateKey", "date"), "dateKey")
        .join(star.dim_meter.select("meterKey", "meterCategory", "serviceName"), "meterKey")
    )
    # a day is more than one task can sort; within it the order goes on, so it can be split
    return rows.orderBy(
        F.desc("date"), F.desc("actualCost"), "resourceKey", "meterKey", "amortizedCost", "usageQuantity"
    ).select(
        "resourceId", "resourceName", "resourceType", _iso("date"), "actualCost", "amortizedCost",
        "costInUSD", "usageQuantity", "effectivePrice", "meterCategory", "serviceName",
    )


def _totals(star: Star, start, end, subscription_id: str | None, *keys: str) -> DataFrame:
    """Cost per key inside the range: the partial result that is joined to a dimension."""
    cost = star.cost(["dateKey", "subscriptionKey", "actualCost", *keys], **_range(start, end))
    return (
        cost.join(_subscription(star, subscription_id), "subscriptionKey")
        .join(star.dim_date.select("dateKey"), "dateKey")
        .groupBy(*keys)
        .agg(F.sum("actualCost").alias("totalCost"))
    )


def total_cost(star: Star, start, end, subscription_id: str | None = None) -> DataFrame:
    """One row; 0 when nothing was spent."""
    nothing = F.lit(0).cast("decimal(28,2)")
    return _totals(star, start, end, subscription_id).select(
        F.coalesce(F.col("totalCost"), nothing).alias("totalCost")
    )


def cost_by_service(star: Star, start, end, subscription_id: str | None = None) -> DataFrame:
    return (
        _totals(star, start, end, subscription_id, "meterKey")
        .join(star.dim_meter.select("meterKey", "serviceName"), "meterKey")
        .groupBy("serviceName").agg(F.sum("totalCost").alias("totalCost"))
        .orderBy(F.desc("totalCost"), "serviceName")
    )


def cost_by_resource_group(star: Star, start, end, subscription_id: str | None = None) -> DataFrame:
    return (
        _totals(star, start, end, subscription_id, "resourceKey")
        .join(star.current_resources("resourceGroupName"), "resourceKey")
        .groupBy("resourceGroupName").agg(F.sum("totalCost").alias("totalCost"))
        .orderBy(F.desc("totalCost"), "resourceGroupName")
    )


def rolling_anomalies(daily: DataFrame) -> DataFrame:
    """Days of ``daily`` (dateKey, resourceKey, dailyCost) that leave the band of the six present
    days before them. The window sees one row per resource and day."""
    before = Window.partitionBy("resourceKey").orderBy("dateKey").rowsBetween(-ROLLING_ROWS, -1)
    spent = F.col("dailyCost").cast("double")
    scored = daily.withColumn("mean", F.avg(spent).over(before)).withColumn(
        "deviation", F.stddev_samp(spent).over(before)
    )
    z = F.abs(F.try_divide(spent - F.col("mean"), F.col("deviation")))
    return (
        scored.filter(F.col("deviation") > 0)
        .withColumn("zScore", z)
        .filter((F.col("zScore") >= ROLLING_Z) & (F.col("dailyCost") >= ROLLING_MIN_COST))
        .select("dateKey", "resourceKey", "zScore")
    )


def anomalous_cost_data(
    star: Star, as_of: datetime, subscription_id: str | None = None, days_back: int = 30
) -> DataFrame:
    """Cost rows of resource-days with an unusual total, most unusual first."""
    span = _range(days_before(as_of, days_back), as_of)
    daily = (
        star.cost(["dateKey", "resourceKey", "subscriptionKey", "actualCost"], **span)
        .join(_subscription(star, subscription_id), "subscriptionKey")
        .groupBy("dateKey", "resourceKey").agg(F.sum("actualCost").alias("dailyCost"))
        .join(star.dim_date.select("dateKey"), "dateKey")
    )
    flagged = rolling_anomalies(daily).join(star.current_resources("resourceId", "resourceName"), "resourceKey")
    rows = (
        star.cost(["dateKey", "resourceKey", "meterKey", "actualCost", "amortizedCost", "costInUSD"], **span)
        .join(flagged, ["dateKey", "resourceKey"])
        .join(star.dim_date.select("dateKey", "date"), "dateKey")
        .join(star.dim_meter.select("meterKey", "meterCategory", "serviceName"), "meterKey")
    )
    return rows.orderBy(F.desc("zScore"), F.desc("actualCost"), "resourceKey", "date", "meterKey", "amortizedCost").select(
        "resourceId", "resourceName", _iso("date"), "actualCost", "amortizedCost", "costInUSD",
        "meterCategory", "serviceName", "zScore",
        F.format_string("Z-Score: %.2f", "zScore").alias("additionalInfo"),
    )
