"""Which services and tags a flagged day's variance comes from."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dbl
from ..functions.dates import days_before, first_day_from, last_day_until
from ..star import Star
from .anomaly import DETECTION_DAYS

EXPLAINED = 0.8


def _leading(parts: DataFrame, whole: list[str], explained: float) -> DataFrame:
    """The parts with the sign of the whole's variance, largest first, until they reach the share."""
    order = Window.partitionBy(*whole).orderBy(F.desc(F.abs("variance")), *[c for c in ("serviceName", "tagValue") if c in parts.columns])
    before = F.coalesce(F.sum(F.abs("variance")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    same = parts.filter(F.signum("variance") == F.signum("dayVariance"))
    return same.withColumns({"before": before, "rank": F.row_number().over(order)}).filter(
        F.col("before") < explained * F.abs("dayVariance")).drop("before")


def variance_by_cell(star: Star, flagged: DataFrame, as_of: datetime, tag: str = "app", days: int = DETECTION_DAYS,
                     explained: float = EXPLAINED) -> DataFrame:
    """For every row of ``flagged`` (dateKey, subscriptionKey, isAnomaly) the few (service, tag value)
    cells that explain its variance.

    A cell's variance is its cost of the day less its mean over the days on which the subscription
    had cost. The search goes down the roll-up: services first, the largest in the direction of the
    day's variance until they reach the share; only inside these the cells, again largest first. So
    cells of services that do not matter are never ranked. The fact is reduced to day, meter and
    resource before dimensions are joined; flagged days meet the cells by an equality join.
    """
    reduced = star.cost(["dateKey", "subscriptionKey", "meterKey", "resourceKey", "actualCost"],
                        since=first_day_from(days_before(as_of, days)), until=last_day_until(as_of)).groupBy(
        "dateKey", "subscriptionKey", "meterKey", "resourceKey").agg(F.sum("actualCost").alias("cost"))
    cells = (
        reduced.join(star.dim_meter.select("meterKey", "serviceName"), "meterKey")
        .join(star.dim_resource.select("resourceKey", F.col(tag).alias("tagValue")), "resourceKey", "left")
        .groupBy("dateKey", "subscriptionKey", "serviceName", "tagValue").agg(F.sum("cost").alias("cost"))
    )
    present = cells.groupBy("subscriptionKey").agg(F.count_distinct("dateKey").alias("days"))
    mean = cells.groupBy("subscriptionKey", "serviceName", "tagValue").agg(F.sum("cost").alias("total")).join(
        present, "subscriptionKey").select("subscriptionKey", "serviceName", "tagValue", (dbl("total") / F.col("days")).alias("mean"))
    marked = flagged.filter("isAnomaly").select("dateKey", "subscriptionKey").distinct()
    day = ["dateKey", "subscriptionKey"]
    # every cell the subscription ever had, also those that cost nothing on the day
    spent = cells.select(*day, "serviceName", F.coalesce("tagValue", F.lit("")).alias("tagValue"), "cost")
    usual = mean.withColumn("tagValue", F.coalesce("tagValue", F.lit("")))
    varied = marked.join(usual, "subscriptionKey").join(spent, [*day, "serviceName", "tagValue"], "left").withColumn(
        "variance", F.coalesce(dbl("cost"), F.lit(0.0)) - F.col("mean"))
    whole = varied.groupBy(*day).agg(F.sum("variance").alias("dayVariance"))
    services = varied.groupBy(*day, "serviceName").agg(F.sum("variance").alias("variance")).join(whole, day)
    chosen = _leading(services, day, explained).select(*day, "serviceName")
    inside = varied.join(chosen, [*day, "serviceName"]).select(*day, "serviceName", "tagValue", "variance").join(whole, day)
    return _leading(inside, day, explained).select(
        *day, "serviceName", "tagValue", "variance", (F.col("variance") / F.col("dayVariance")).alias("share"), "rank")
