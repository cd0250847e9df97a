"""Key figures over the cost star.

Wide dimensions (resource, meter) are joined only after the fact is aggregated to their key, so
no raw fact row is shuffled for them; calendar and subscription are joined directly.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import mean_price, month_index, ratio_or_zero, safe_divide, stamp, total
from ..functions.dates import days_before, first_day_from, months_before
from ..star import Star

# Rolling windows, status names and utilization limits.
EXECUTIVE_MONTHS = 13
GROWTH_MONTHS = 2
SERVICE_MONTHS = 3
SAVINGS_MONTHS = 12
COVERAGE_MONTHS = 3
BUDGET_MONTHS = 12
UTILIZATION_DAYS = 30
ANOMALY_DAYS = 30
CPU_LOW = 20
CPU_HIGH = 80


def _dated(cost: DataFrame, star: Star, *attributes: str) -> DataFrame:
    return cost.join(star.dim_date.select("dateKey", *attributes), "dateKey")


def _subscribed(cost: DataFrame, star: Star, *attributes: str) -> DataFrame:
    return cost.join(star.dim_subscription.select("subscriptionKey", *attributes), "subscriptionKey")


def executive_kpis(
    star: Star, as_of: datetime, forecast: DataFrame | None = None, approximate_counts: bool = False
) -> DataFrame:
    """Daily cost per subscription with the previous present day and the previous calendar month.

    One pass over the fact. Both comparisons are windows over the aggregated days of a
    subscription; the month total is a value-range frame on the month number, so a missing
    month yields NULL. ``forecast`` (date, subscriptionId, forecastedCost) fills the forecast column,
    0 without it. ``approximate_counts`` swaps the two exact distinct counts for sketches.
    """
    count_distinct = F.approx_count_distinct if approximate_counts else F.count_distinct
    cost = star.cost(
        ["dateKey", "subscriptionKey", "resourceKey", "meterKey", "actualCost", "amortizedCost", "costInUSD"],
        since=first_day_from(months_before(as_of, EXECUTIVE_MONTHS)),
    )
    # the distinct counts expand narrow rows of keys; names join the finished days
    by_key = cost.groupBy("dateKey", "subscriptionKey").agg(
        F.sum("actualCost").alias("totalActualCost"),
        F.sum("amortizedCost").alias("totalAmortizedCost"),
        F.sum("costInUSD").alias("totalCostUSD"),
        count_distinct("resourceKey").alias("activeResourceCount"),
        count_distinct("meterKey").alias("uniqueServiceCount"),
    )
    daily = _subscribed(
        _dated(by_key, star, "date", "year", "month", "quarter"),
        star, "subscriptionId", "subscriptionName", "businessUnit",
    ).drop("dateKey", "subscriptionKey")
    if forecast is None:
        daily = daily.withColumn("forecastedCost", F.lit(0))
    else:
        daily = daily.join(forecast, ["date", "subscriptionId"], "left").withColumn(
            "forecastedCost", F.coalesce(F.col("forecastedCost"), F.lit(0)))
    subscription = Window.partitionBy("subscriptionId")
    months = month_index(F.col("year"), F.col("month"))
    return daily.select(
        "date", "year", "month", "quarter", "subscriptionName", "businessUnit",
        "totalActualCost", "totalAmortizedCost", "totalCostUSD",
        F.lag("totalActualCost").over(subscription.orderBy("date")).alias("previousDayCost"),
        F.sum("totalActualCost").over(subscription.orderBy(months).rangeBetween(-1, -1)).alias("previousMonthCost"),
        "activeResourceCount", "uniqueServiceCount",
        "forecastedCost",
        stamp(as_of).alias("calculationDate"),
    )


def mom_growth(star: Star, as_of: datetime) -> DataFrame:
    """Month totals next to the previous calendar month; growth is 0 without a previous total."""
    cost = star.cost(
        ["dateKey", "subscriptionKey", "actualCost"],
        since=first_day_from(months_before(as_of, GROWTH_MONTHS)),
    )
    monthly = (
        _subscribed(_dated(cost, star, "year", "month"), star, "subscriptionId", "subscriptionName")
        .groupBy("subscriptionId", "subscriptionName", "year", "month")
        .agg(F.sum("actualCost").alias("currentMonthCost"))
    )
    previous_month = (
        Window.partitionBy("subscriptionId")
        .orderBy(month_index(F.col("year"), F.col("month")))
        .rangeBetween(-1, -1)
    )
    change = F.col("currentMonthCost") - F.col("previousMonthCost")
    return monthly.withColumn(
        "previousMonthCost", F.sum("currentMonthCost").over(previous_month)
    ).select(
        "subscriptionId", "subscriptionName", "year", "month", "currentMonthCost", "previousMonthCost",
        (ratio_or_zero(change, F.col("previousMonthCost")) * 100).alias("momGrowthPercentage"),
        change.alias("momCostChange"),
    )


def service_cost_breakdown(star: Star, as_of: datetime) -> DataFrame:
    """Daily cost per subscription and service. Equal subscription names stay separate rows."""
    partial = (
        star.cost(
            ["dateKey", "subscriptionKey", "meterKey", "resourceKey", "actualCost", "usageQuantity", "effectivePrice"],
            since=first_day_from(months_before(as_of, SERVICE_MONTHS)),
        )
        .groupBy("dateKey", "subscriptionKey", "meterKey", "resourceKey")
        .agg(total("actualCost"), total("usageQuantity"), total("effectivePrice"),
             F.count("effectivePrice").alias("prices"))
    )
    meters = star.dim_meter.select("meterKey", "serviceName", "meterCategory", "meterSubCategory")
    services = _subscribed(
        _dated(partial, star, "date"), star, "subscriptionId", "subscriptionName"
    ).join(meters, "meterKey")
    per_service = services.groupBy(
        "date", "subscriptionId", "subscriptionName", "serviceName", "meterCategory", "meterSubCategory"
    ).agg(
        F.sum("actualCost").alias("totalCost"),
        F.sum("usageQuantity").alias("totalUsage"),
        mean_price(F.sum("effectivePrice"), F.sum("prices")).alias("avgEffectivePrice"),
        F.count_distinct("resourceKey").alias("resourceCount"),
    )
    return per_service.select(
        "date", "subscriptionName", "serviceName", "meterCategory", "meterSubCategory",
        "totalCost", "totalUsage", "avgEffectivePrice", "resourceCount",
        ratio_or_zero(F.col("totalCost"), F.col("resourceCount")).alias("costPerResource"),
    )


def utilization_status(cpu: Column) -> Column:
    return (
        F.when(cpu < CPU_LOW, "Underutilized").when(cpu > CPU_HIGH, "Overutilized").otherwise("Optimal")
    )


def resource_utilization(star: Star, as_of: datetime) -> DataFrame:
    """Utilization per current resource and day next to the cost of that day."""
    since = first_day_from(days_before(as_of, UTILIZATION_DAYS))
    cost = (
        star.cost(["dateKey", "resourceKey", "actualCost"], since=since)
        .groupBy("dateKey", "resourceKey")
        .agg(F.sum("actualCost").alias("totalCost"))
    )
    attributes = ["resourceName", "resourceType", "subscriptionName", "businessUnit", "team", "costCenter"]
    used = (
        _dated(star.utilization(since=since), star, "date")
        .join(cost, ["dateKey", "resourceKey"], "left")
        .join(star.current_resources(*attributes), "resourceKey")
    )
    cpu, spent = F.col("avgCpuPercentage"), F.col("totalCost")
    return used.select(
        "date", "resourceKey", "resourceId", *attributes,
        "avgCpuPercentage", "maxCpuPercentage", "avgMemoryPercentage", "maxMemoryPercentage",
        "idlePercentage", "uptimeHours", "availabilityPercentage",
        "totalCost", spent.alias("dailyCost"),
        F.when(spent > 0, ratio_or_zero(spent, cpu)).otherwise(0.0).alias("costPerCpuPercent"),
        utilization_status(cpu).alias("utilizationStatus"),
    )


def savings_opportunities(star: Star, as_of: datetime) -> DataFrame:
    """Opportunities of current resources by owner, type, status and priority."""
    measures = ["potentialMonthlySavings", "potentialAnnualSavings", "realizedMonthlySavings", "realizedAnnualSavings"]
    partial = (
        star.fact_savings_opportunity
        .filter(F.col("recommendationDate") >= F.lit(first_day_from(months_before(as_of, SAVINGS_MONTHS))))
        .groupBy("resourceKey", "recommendationType", "status", "priority")
        .agg(F.count(F.lit(1)).alias("opportunities"),
             F.count("potentialMonthlySavings").alias("priced"), *[total(m) for m in measures])
    )
    grouped = (
        partial.join(star.current_resources("subscriptionName", "businessUnit", "team"), "resourceKey")
        .groupBy("subscriptionName", "businessUnit", "team", "recommendationType", "status", "priority")
        .agg(F.sum("opportunities").alias("opportunityCount"),
             F.sum("priced").alias("priced"),
             *[F.sum(m).alias("total" + m[0].upper() + m[1:]) for m in measures])
    )
    potential = F.col("totalPotentialMonthlySavings")
    return grouped.select(
        "subscriptionName", "businessUnit", "team", "recommendationType", "status", "priority",
        "opportunityCount", "totalPotentialMonthlySavings", "totalPotentialAnnualSavings",
        "totalRealizedMonthlySavings", "totalRealizedAnnualSavings",
        safe_divide(potential, F.col("priced")).alias("avgPotentialMonthlySavings"),
        (ratio_or_zero(F.col("totalRealizedMonthlySavings"), potential) * 100).alias("implementationRate"),
    )


def anomaly_summary(star: Star, as_of: datetime) -> DataFrame:
    """Flagged anomalies per day, subscription and business unit (NULL at subscription level)."""
    flagged = star.anomalies(since=first_day_from(days_before(as_of, ANOMALY_DAYS))).filter("isAnomaly")
    joined = _subscribed(
        _dated(flagged, star, "date"), star, "subscriptionId", "subscriptionName"
    ).join(star.current_resources("businessUnit"), "resourceKey", "left")
    severity = F.col("severity")
    return (
        joined.groupBy("date", "subscriptionId", "subscriptionName", "businessUnit")
        .agg(
            F.count(F.lit(1)).alias("totalAnomalies"),
            F.count_if(severity == "High").alias("highSeverityAnomalies"),
            F.count_if(severity == "Medium").alias("mediumSeverityAnomalies"),
            F.count_if(severity == "Low").alias("lowSeverityAnomalies"),
            F.sum("costVariance").alias("totalCostVariance"),
            F.avg("variancePercentage").alias("avgVariancePercentage"),
            F.max("zScore").alias("maxZScore"),
            F.avg("zScore").alias("avgZScore"),
        )
        .drop("subscriptionId")
    )


def reservation_coverage(star: Star, as_of: datetime) -> DataFrame:
    """Covered cost per benefit. Only covered rows qualify, so coverage is 100 wherever cost is
    positive; coverage over all cost is the measure "Reservation Coverage %"."""
    reserved, planned = F.col("isReservationCharge"), F.col("isSavingsPlanCharge")
    cost = star.cost(
        ["dateKey", "subscriptionKey", "benefitKey", "actualCost", "isReservationCharge", "isSavingsPlanCharge"],
        since=first_day_from(months_before(as_of, COVERAGE_MONTHS)),
    ).filter(reserved | planned)
    benefit = ["benefitType", "productName", "term", "scope", "utilizationPercentage"]
    joined = _subscribed(
        _dated(cost, star, "date"), star, "subscriptionId", "subscriptionName"
    ).join(star.dim_benefit.select("benefitKey", *benefit), "benefitKey", "left")
    spent, nothing = F.col("actualCost"), F.lit(0).cast("decimal(18,2)")
    grouped = joined.groupBy("date", "subscriptionId", "subscriptionName", *benefit).agg(
        F.sum(spent).alias("totalCost"),
        F.sum(F.when(reserved, spent).otherwise(nothing)).alias("reservationCost"),
        F.sum(F.when(planned, spent).otherwise(nothing)).alias("savingsPlanCost"),
        F.sum(F.when(reserved | planned, spent).otherwise(nothing)).alias("coveredCost"),
    )
    used = F.col("utilizationPercentage")
    unused_share = 100 - used.cast("double")
    return grouped.select(
        "date", "subscriptionName", *benefit, "totalCost", "reservationCost", "savingsPlanCost",
        (ratio_or_zero(F.col("coveredCost"), F.col("totalCost")) * 100).alias("coveragePercentage"),
        F.when(used < 100, F.col("reservationCost").cast("double") * unused_share / 100)
        .otherwise(0.0).alias("unusedReservationCost"),
    )


def budget_vs_actual(star: Star, as_of: datetime, budgets: DataFrame | None = None) -> DataFrame:
    """Month cost against budget. Without ``budgets`` (subscriptionId, year, month, budgetAmount)
    the budget is 0."""
    cost = star.cost(
        ["dateKey", "subscriptionKey", "actualCost"],
        since=first_day_from(months_before(as_of, BUDGET_MONTHS)),
    )
    monthly = (
        _subscribed(
            _dated(cost, star, "year", "month", "quarter"),
            star, "subscriptionId", "subscriptionName", "businessUnit",
        )
        .groupBy("year", "month", "quarter", "subscriptionId", "subscriptionName", "businessUnit")
        .agg(F.sum("actualCost").alias("actualCost"))
    )
    no_budget = F.lit(0).cast("decimal(18,2)")
    if budgets is None:
        planned = monthly.withColumn("budgetAmount", no_budget)
    else:
        planned = monthly.join(budgets, ["subscriptionId", "year", "month"], "left").withColumn(
            "budgetAmount", F.coalesce(F.col("budgetAmount"), no_budget)
        )
    spent, budget = F.col("actualCost"), F.col("budgetAmount")
    return planned.select(
        "year", "month", "quarter", "subscriptionName", "businessUnit", "actualCost", "budgetAmount",
        (spent - budget).alias("variance"),
        (ratio_or_zero(spent, budget) * 100).alias("budgetUtilizationPercentage"),
    )
