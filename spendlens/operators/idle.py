"""Runs of consecutive idle days per resource."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl
from ..star import Star


def idle_runs(star: Star, min_idle: float = 80.0, min_days: int = 3, since: date | None = None) -> DataFrame:
    """Stretches of at least ``min_days`` calendar days on each of which a current resource was idle
    for ``min_idle`` percent, with their cost. A day without a measurement ends a run.

    Days of a run share the difference between their date and their rank. A window holds the days of
    one resource; cost rows are summed per resource and day before they meet the run's days.
    """
    days = (
        star.utilization(since=since).filter(dbl("idlePercentage") >= min_idle)
        .groupBy("dateKey", "resourceKey").agg(F.max(dbl("idlePercentage")).alias("idle"))
        .join(star.dim_date.select("dateKey", "date"), "dateKey")
    )
    resource = Window.partitionBy("resourceKey").orderBy("date")
    grouped = days.withColumn("run", F.date_sub("date", F.row_number().over(resource)))
    spent = star.cost(["dateKey", "resourceKey", "actualCost"], since=since).groupBy("dateKey", "resourceKey").agg(
        F.sum("actualCost").alias("cost"))
    runs = grouped.join(spent, ["dateKey", "resourceKey"], "left").groupBy("resourceKey", "run").agg(
        F.min("date").alias("firstDay"), F.max("date").alias("lastDay"), F.count(F.lit(1)).alias("idleDays"),
        F.avg("idle").alias("avgIdlePercentage"), F.sum("cost").alias("cost"))
    nothing = F.lit(0).cast("decimal(28,2)")
    return runs.filter(F.col("idleDays") >= min_days).join(
        star.current_resources("resourceId", "resourceName", "team"), "resourceKey").select(
        "resourceId", "resourceName", "team", "firstDay", "lastDay", "idleDays", "avgIdlePercentage",
        F.coalesce(F.col("cost").cast("decimal(28,2)"), nothing).alias("cost"))
