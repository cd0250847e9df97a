"""Forecasts, budget crossings, governance and rankings over the cost star."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl, safe_divide, stamp
from ..functions.dates import days_before, first_day_from, last_day_until
from ..functions.quantiles import percentiles
from ..star import Star
from .costs import TAG_COLUMNS

# Forecast horizons, budget thresholds, interval width.
HORIZONS = (30, 60, 90)
BUDGET_THRESHOLDS = (50, 75, 90, 100)
Z95 = 1.96
Z90_ONE_SIDED = 1.2816


def _daily_by_subscription(star: Star, since, until) -> DataFrame:
    return (
        star.cost(["dateKey", "subscriptionKey", "actualCost"], since=since, until=until)
        .groupBy("dateKey", "subscriptionKey").agg(F.sum("actualCost").alias("dailyCost"))
        .join(star.dim_date.select("dateKey", "date"), "dateKey")
    )


def linear_forecast(star: Star, as_of: datetime, history_days: int = 90,
                    horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Straight-line forecast of the daily cost per subscription with a 95 % band.

    The fit is five sums per subscription, so any history length costs one small aggregate.
    """
    today = last_day_until(as_of)
    daily = _daily_by_subscription(star, first_day_from(days_before(as_of, history_days)), today)
    x, y = F.date_diff("date", F.lit(today)).cast("double"), dbl("dailyCost")
    fit = daily.groupBy("subscriptionKey").agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"), F.count(F.lit(1)).alias("days"),
    )
    residual = F.sqrt(F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)) / (F.col("days") - 2))
    target = F.date_add(F.lit(today), F.col("forecastHorizonDays"))
    expected = F.col("intercept") + F.col("slope") * F.col("forecastHorizonDays")
    return (
        fit.filter((F.col("days") > 2) & F.col("slope").isNotNull())
        .withColumn("residual", residual)
        .withColumn("forecastHorizonDays", F.explode(F.array(*[F.lit(h) for h in horizons])))
        .select(
            F.date_format(target, "yyyyMMdd").cast("int").alias("dateKey"), "subscriptionKey",
            expected.alias("forecastedCost"),
            (expected - F.col("residual") * Z95).alias("confidenceIntervalLower"),
            (expected + F.col("residual") * Z95).alias("confidenceIntervalUpper"),
            expected.alias("p50Forecast"),
            (expected + F.col("residual") * Z90_ONE_SIDED).alias("p90Forecast"),
            F.lit("Linear").alias("modelType"), "forecastHorizonDays", stamp(as_of).alias("forecastDate"),
        )
    )


def budget_crossings(star: Star, budgets: DataFrame, thresholds: Sequence[int] = BUDGET_THRESHOLDS) -> DataFrame:
    """First day of each month on which the running cost reaches a share of the budget. A window
    holds at most one month of days."""
    daily = (
        star.cost(["dateKey", "subscriptionKey", "actualCost"])
        .groupBy("dateKey", "subscriptionKey").agg(F.sum("actualCost").alias("dailyCost"))
        .join(star.dim_date.select("dateKey", "date", "year", "month"), "dateKey")
        .join(star.dim_subscription.select("subscriptionKey", "subscriptionId"), "subscriptionKey")
        .join(budgets, ["subscriptionId", "year", "month"])
    )
    to_date = Window.partitionBy("subscriptionId", "year", "month").orderBy("date")
    running = daily.withColumn("spent", F.sum("dailyCost").over(to_date))
    limits = running.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    reached = F.col("spent") * 100 >= F.col("budgetAmount") * F.col("threshold")
    return (
        limits.filter(reached & (F.col("budgetAmount") > 0))
        .groupBy("subscriptionId", "year", "month", "threshold", "budgetAmount")
        .agg(F.min("date").alias("reachedOn"), F.min("spent").alias("spent"))
    )


def tag_compliance(star: Star, required: Sequence[str] | None = None) -> DataFrame:
    """Per business unit and required tag: current resources and how many lack the tag. Without
    ``required`` the tag dimension says which tags are."""
    names = TAG_COLUMNS if required is None else required
    values = F.create_map(*[e for name in names for e in (F.lit(name), F.col(TAG_COLUMNS[name]))])
    tagged = star.dim_resource.filter("isCurrent").select(
        F.col("businessUnit").alias("unit"), F.explode(values).alias("tagName", "tagValue")
    )
    if required is None:
        mandatory = star.dim_tag_kv.filter("isRequired").select(F.col("tagKeyName").alias("tagName"))
        tagged = tagged.join(mandatory, "tagName", "left_semi")
    missing = F.count_if(F.col("tagValue").isNull() | (F.col("tagValue") == ""))
    return (
        tagged.groupBy("unit", "tagName").agg(F.count(F.lit(1)).alias("resources"), missing.alias("missing"))
        .select(F.col("unit").alias("businessUnit"), "tagName", "resources", "missing",
                (safe_divide(F.col("resources") - F.col("missing"), F.col("resources")) * 100).alias("compliancePercentage"))
    )


def unused_resources(star: Star, as_of: datetime, days: int = 30) -> DataFrame:
    """Current resources without any cost row in the last days."""
    used = star.cost(["resourceKey"], since=first_day_from(days_before(as_of, days)),
                     until=last_day_until(as_of)).distinct()
    return star.current_resources("resourceId", "resourceName", "resourceType", "resourceGroupName").join(
        used, "resourceKey", "left_anti")


def idle_resources(star: Star, as_of: datetime, days: int = 30, min_idle: float = 80.0) -> DataFrame:
    """Current resources that were mostly idle on average, with their cost of the same days."""
    since = first_day_from(days_before(as_of, days))
    idle = (
        star.utilization(since=since).groupBy("resourceKey")
        .agg(safe_divide(F.sum(dbl("idlePercentage")), F.count("idlePercentage")).alias("avgIdlePercentage"))
        .filter(F.col("avgIdlePercentage") >= min_idle)
    )
    cost = star.cost(["resourceKey", "actualCost"], since=since).groupBy("resourceKey").agg(
        F.sum("actualCost").alias("totalCost"))
    return (
        star.current_resources("resourceId", "resourceName", "team").join(idle, "resourceKey")
        .join(cost, "resourceKey", "left")
    )


def empty_resource_groups(star: Star) -> DataFrame:
    """Resource groups without a current resource."""
    return star.dim_resource_group.select("resourceGroupKey", "resourceGroupName", "subscriptionId").join(
        star.dim_resource.filter("isCurrent").select("resourceGroupName", "subscriptionId").distinct(),
        ["resourceGroupName", "subscriptionId"], "left_anti")


def reservation_candidates(star: Star, as_of: datetime, days: int = 90, share: float = 0.2) -> DataFrame:
    """Per service the daily on-demand cost that is exceeded on most days: the amount worth
    committing to. ``share`` is the percentile of the daily totals."""
    on_demand = (
        star.cost(["dateKey", "meterKey", "actualCost", "isReservationCharge", "isSavingsPlanCharge"],
                  since=first_day_from(days_before(as_of, days)))
        .filter(~F.col("isReservationCharge") & ~F.col("isSavingsPlanCharge"))
        .groupBy("dateKey", "meterKey").agg(F.sum("actualCost").alias("cost"))
        .join(star.dim_meter.select("meterKey", "serviceName"), "meterKey")
        .groupBy("serviceName", "dateKey").agg(F.sum("cost").alias("dailyCost"))
    )
    commitment = percentiles(on_demand, ["serviceName"], "dailyCost", {"dailyCommitment": share})
    spent = on_demand.groupBy("serviceName").agg(
        F.sum("dailyCost").alias("onDemandCost"), F.count(F.lit(1)).alias("activeDays"))
    return spent.join(commitment, "serviceName")


def top_cost_drivers(star: Star, as_of: datetime, days: int = 30, top: int = 10) -> DataFrame:
    """The costliest current resources of the last days: a report of ``top`` rows."""
    cost = star.cost(["resourceKey", "actualCost"], since=first_day_from(days_before(as_of, days))).groupBy(
        "resourceKey").agg(F.sum("actualCost").alias("totalCost"))
    return (
        cost.join(star.current_resources("resourceId", "resourceName", "businessUnit"), "resourceKey")
        .orderBy(F.desc("totalCost"), "resourceId").limit(top)
    )


def top_movers(star: Star, as_of: datetime, days: int = 30, top: int = 10) -> DataFrame:
    """Services with the largest change between the last days and the days before."""
    middle, first = first_day_from(days_before(as_of, days)), first_day_from(days_before(as_of, 2 * days))
    split = star.dim_date.select("dateKey", (F.col("date") >= F.lit(middle)).alias("recent"))
    partial = star.cost(["dateKey", "meterKey", "actualCost"], since=first).groupBy("dateKey", "meterKey").agg(
        F.sum("actualCost").alias("cost"))
    spent, nothing = F.col("cost"), F.lit(0).cast("decimal(18,2)")
    services = (
        partial.join(split, "dateKey")
        .join(star.dim_meter.select("meterKey", "serviceName"), "meterKey")
        .groupBy("serviceName")
        .agg(F.sum(F.when(F.col("recent"), spent).otherwise(nothing)).alias("currentCost"),
             F.sum(F.when(~F.col("recent"), spent).otherwise(nothing)).alias("previousCost"))
    )
    change = F.col("currentCost") - F.col("previousCost")
    return (
        services.withColumn("change", change)
        .orderBy(F.desc(F.abs("change")), "serviceName").limit(top)
    )


def cost_utilization_correlation(star: Star) -> DataFrame:
    """Correlation between daily cost and CPU per business unit, over resource-days with both."""
    cost = star.cost(["dateKey", "resourceKey", "actualCost"]).groupBy("dateKey", "resourceKey").agg(
        F.sum("actualCost").alias("dailyCost"))
    paired = star.utilization().join(cost, ["dateKey", "resourceKey"]).join(
        star.current_resources("businessUnit"), "resourceKey")
    return paired.filter(F.col("avgCpuPercentage").isNotNull()).groupBy("businessUnit").agg(
        F.count(F.lit(1)).alias("resourceDays"),
        F.corr(dbl("dailyCost"), dbl("avgCpuPercentage")).alias("correlation"))


def cost_distribution(star: Star, *attributes: str) -> DataFrame:
    """Total cost and its share per member of the given resource attributes."""
    cost = star.cost(["resourceKey", "actualCost"]).groupBy("resourceKey").agg(F.sum("actualCost").alias("cost"))
    members = (
        cost.join(star.dim_resource.select("resourceKey", *attributes), "resourceKey", "left")
        .groupBy(*attributes).agg(F.sum("cost").alias("totalCost"))
    )
    whole = cost.agg(F.sum("cost")).scalar()
    return members.withColumn("share", safe_divide(F.col("totalCost"), whole) * 100)
