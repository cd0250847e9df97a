"""Savings recommendations: from utilization and from advisor texts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import stamp
from ..star import Star
from .enrichment import cost_advisor_recommendations
from .kpis import CPU_LOW, resource_utilization
from .rollup import current_key_by_id

# Recommendation text, limits, saving share and status names.
RIGHT_SIZE = "RightSize"
RIGHT_SIZE_TEXT = "Resource has been underutilized for 7+ days. Consider downsizing."
RIGHT_SIZE_MIN_COST = 50
SAVING_SHARE = "0.3"
HIGH_COST = 1000
MEDIUM_COST = 100
OPEN_STATUSES = ("Pending", "InProgress")
COVERED_STATUSES = ("Pending", "InProgress", "Completed")
STATUS_BY_ADVISOR = {"Dismissed": "Rejected", "Postponed": "Pending"}
CATEGORY_BY_TYPE = {"RightSize": "Right Size", "Idle": "Idle Resources"}


def generate_rightsizing(
    star: Star, as_of: datetime, existing: DataFrame | None = None, one_per_resource: bool = False
) -> DataFrame:
    """Rows to append to ``fact_savings_opportunity``: underutilized resource-days above the cost
    limit, unless the resource has an open recommendation of this type in ``existing``.

    ``one_per_resource`` keeps only the costliest day of a resource.
    """
    spent = F.col("totalCost")
    found = resource_utilization(star, as_of).filter(
        (F.col("utilizationStatus") == "Underutilized")
        & (F.col("avgCpuPercentage") < CPU_LOW)
        & (spent > RIGHT_SIZE_MIN_COST)
    ).select("resourceKey", "resourceId", "date", "totalCost")
    if existing is not None:
        open_ones = existing.filter(
            (F.col("recommendationType") == RIGHT_SIZE) & F.col("status").isin(*OPEN_STATUSES)
        ).select("resourceKey")
        found = found.join(open_ones, "resourceKey", "left_anti")
    if one_per_resource:
        found = found.groupBy("resourceKey", "resourceId").agg(F.max("totalCost").alias("totalCost"))
    today = (
        star.dim_date.filter(F.col("date") <= F.lit(as_of.date())).agg(F.max("dateKey")).scalar()
    )
    monthly = spent * F.lit(SAVING_SHARE).cast("decimal(2,1)")
    nothing = F.lit(0).cast("decimal(18,2)")
    return found.select(
        today.alias("dateKey"), "resourceKey", "resourceId",
        F.lit(RIGHT_SIZE).alias("recommendationType"),
        F.lit(RIGHT_SIZE_TEXT).alias("recommendationDescription"),
        monthly.cast("decimal(18,2)").alias("potentialMonthlySavings"),
        (monthly * 12).cast("decimal(18,2)").alias("potentialAnnualSavings"),
        nothing.alias("realizedMonthlySavings"), nothing.alias("realizedAnnualSavings"),
        F.lit("Pending").alias("status"),
        F.when(spent > HIGH_COST, "High").when(spent > MEDIUM_COST, "Medium").otherwise("Low").alias("priority"),
        F.lit(as_of.date()).alias("recommendationDate"),
    )


def _status(advisor_status: Column, otherwise: Column) -> Column:
    chain = F
    for theirs, ours in STATUS_BY_ADVISOR.items():
        chain = chain.when(advisor_status == theirs, ours)
    return chain.otherwise(otherwise)


def _concerns(kind: Column, type_id: Column, category: Column) -> Column:
    """Does a recommendation (type id, category) concern an opportunity of this kind?"""
    match = type_id.contains(kind)
    for name, meant in CATEGORY_BY_TYPE.items():
        match = match | ((kind == name) & (category == meant))
    return match


def _latest(advice: DataFrame, *keys: str) -> DataFrame:
    """Per key the advice with the newest ``lastUpdated``, then the lowest id. Both steps are plain
    aggregates with map-side partial results."""
    return (
        advice.groupBy(*keys, "lastUpdated").agg(F.min_by("advice", "advice.id").alias("advice"))
        .groupBy(*keys)
        .agg(F.max("lastUpdated").alias("lastUpdated"), F.max_by("advice", "lastUpdated").alias("advice"))
    )


def advisor_update(star: Star, as_of: datetime, recommendations: DataFrame | None = None) -> DataFrame:
    """``fact_savings_opportunity`` with the matching recommendation applied: the latest one, then
    the lowest id.

    A match depends only on resource and type, so both sides shrink to their distinct
    (resource, type) pairs first. Many opportunities and many recommendations on one resource
    never meet row by row.
    """
    advice = cost_advisor_recommendations(star) if recommendations is None else recommendations
    opportunities = star.fact_savings_opportunity
    content = F.struct("id", "shortDescription", "potentialMonthlySavings", "status", "priority")
    best_per_type = _latest(
        advice.select("resourceId", "recommendationTypeId", "recommendationCategory", "lastUpdated",
                      content.alias("advice")),
        "resourceId", "recommendationTypeId", "recommendationCategory",
    )
    kinds = opportunities.select("resourceId", "recommendationType").distinct()
    candidates = kinds.join(best_per_type, "resourceId").filter(
        _concerns(F.col("recommendationType"), F.col("recommendationTypeId"), F.col("recommendationCategory"))
    )
    chosen = _latest(candidates, "resourceId", "recommendationType").drop("lastUpdated")
    joined = opportunities.join(chosen, ["resourceId", "recommendationType"], "left")
    matched, advised = F.col("advice").isNotNull(), F.col("advice.potentialMonthlySavings")
    changes = {
        "recommendationDescription": F.coalesce("recommendationDescription", "advice.shortDescription"),
        "potentialMonthlySavings": F.when(advised > 0, advised).otherwise(F.col("potentialMonthlySavings")),
        "potentialAnnualSavings": F.when(advised > 0, (advised * 12).cast("decimal(18,2)"))
        .otherwise(F.col("potentialAnnualSavings")),
        "status": _status(F.col("advice.status"), F.col("status")),
        "priority": F.coalesce("advice.priority", "priority"),
        "rowModifiedDate": F.when(matched, stamp(as_of)),
    }
    if "rowModifiedDate" in opportunities.columns:
        changes["rowModifiedDate"] = F.coalesce(changes["rowModifiedDate"], F.col("rowModifiedDate"))
    untouched = [c for c in opportunities.columns if c not in changes]
    return joined.select(*untouched, *[column.alias(name) for name, column in changes.items()])


def advisor_insert(star: Star, existing: DataFrame | None = None,
                   recommendations: DataFrame | None = None) -> DataFrame:
    """Rows to append to ``fact_savings_opportunity``: priced recommendations without a live
    opportunity of the same resource and category in ``existing``."""
    advice = cost_advisor_recommendations(star) if recommendations is None else recommendations
    priced = advice.filter(F.col("potentialMonthlySavings") > 0)
    if existing is not None:
        live = existing.filter(F.col("status").isin(*COVERED_STATUSES)).select(
            "resourceId", F.col("recommendationType").alias("recommendationCategory")
        )
        priced = priced.join(live, ["resourceId", "recommendationCategory"], "left_anti")
    monthly, nothing = F.col("potentialMonthlySavings"), F.lit(0).cast("decimal(18,2)")
    return (
        priced.withColumn("recommendationDate", F.to_date("createdTime"))
        .join(star.dim_date.select("dateKey", F.col("date").alias("recommendationDate")), "recommendationDate", "left")
        .join(current_key_by_id(star), "resourceId", "left")
        .select(
            "dateKey", "resourceKey", "resourceId",
            F.col("recommendationCategory").alias("recommendationType"),
            F.col("shortDescription").alias("recommendationDescription"),
            "potentialMonthlySavings",
            (monthly * 12).cast("decimal(18,2)").alias("potentialAnnualSavings"),
            nothing.alias("realizedMonthlySavings"), nothing.alias("realizedAnnualSavings"),
            _status(F.col("status"), F.lit("Pending")).alias("status"),
            "priority", "recommendationDate",
        )
    )
