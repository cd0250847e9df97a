"""How much to commit to: the daily amount per service and term that saves most."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_divide
from ..functions.dates import days_before, first_day_from, last_day_until
from ..star import Star

# Price of a committed amount in percent of the on-demand price; a caller gives the contract's own.
PRICE_PERCENT = {"1Year": 72, "3Years": 54}


def on_demand_days(star: Star, as_of: datetime, days: int) -> DataFrame:
    """serviceName, dateKey, dailyCost of charges that no reservation or plan covers."""
    return (
        star.cost(["dateKey", "meterKey", "actualCost", "isReservationCharge", "isSavingsPlanCharge"],
                  since=first_day_from(days_before(as_of, days - 1)), until=last_day_until(as_of))
        .filter(~F.col("isReservationCharge") & ~F.col("isSavingsPlanCharge"))
        .groupBy("dateKey", "meterKey").agg(F.sum("actualCost").alias("cost"))
        .join(star.dim_meter.select("meterKey", "serviceName"), "meterKey")
        .groupBy("serviceName", "dateKey").agg(F.sum("cost").cast("decimal(18,2)").alias("dailyCost"))
    )


def purchase_quantity(star: Star, as_of: datetime, days: int = 90,
                      price_percent: Mapping[str, int] = PRICE_PERCENT) -> DataFrame:
    """Per service and term the daily commitment with the largest saving over the last ``days`` days.

    A commitment of c costs c times the price on every calendar day and covers min(demand, c) of it;
    days without demand count as 0. The saving changes its slope at the demands of the days only, so
    these are the candidates. In order of the demand, prefix sums give what each would cover. Ties go
    to the smaller commitment; a service that no commitment pays for gets 0.
    """
    demand = on_demand_days(star, as_of, days).filter("dailyCost > 0")
    # equal days first: a window holds at most one calendar
    amounts = demand.groupBy("serviceName", "dailyCost").agg(F.count(F.lit(1)).alias("equalDays"))
    upwards = Window.partitionBy("serviceName").orderBy("dailyCost").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy("serviceName").orderBy("dailyCost").rowsBetween(1, Window.unboundedFollowing)
    amount = F.col("dailyCost")
    candidates = amounts.select(
        "serviceName", amount.alias("dailyCommitment"),
        (F.sum(amount * F.col("equalDays")).over(upwards)
         + amount * F.coalesce(F.sum("equalDays").over(above), F.lit(0))).cast("decimal(28,2)").alias("coveredAmount"))
    spent = demand.groupBy("serviceName").agg(
        F.sum("dailyCost").cast("decimal(28,2)").alias("onDemandCost"), F.count(F.lit(1)).alias("activeDays"))
    none = spent.select("serviceName", F.lit(0).cast("decimal(18,2)").alias("dailyCommitment"),
                        F.lit(0).cast("decimal(28,2)").alias("coveredAmount"))
    terms = F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.lit(p).alias("percent")) for t, p in sorted(price_percent.items())]))
    bought = F.col("dailyCommitment") * F.lit(days)
    # whole ten-thousandths of money, so ties are ties
    saving = (F.col("coveredAmount") * 100 - bought * F.col("offer.percent")).cast("decimal(38,2)")
    rows = candidates.unionByName(none).withColumn("offer", terms).withColumn("gain", saving)
    best = rows.groupBy("serviceName", "offer").agg(
        F.max_by(F.struct("dailyCommitment", "coveredAmount", "gain"), F.struct("gain", -F.col("dailyCommitment"))).alias("best")
    ).select("serviceName", "offer.term", "offer.percent", "best.*")
    return best.join(spent, "serviceName").select(
        "serviceName", "term", "activeDays", "onDemandCost", "dailyCommitment", "coveredAmount",
        (bought - F.col("coveredAmount")).cast("decimal(28,2)").alias("wastedAmount"),
        (F.col("gain") / 100).cast("decimal(28,2)").alias("saving"),
        (safe_divide(F.col("coveredAmount"), F.col("onDemandCost")) * 100).alias("coveragePercentage"),
        (safe_divide(F.col("coveredAmount"), bought) * 100).alias("utilizationPercentage"))
