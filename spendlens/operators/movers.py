"""Why the cost of a service changed: price, quantity and mix, adding up exactly."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, safe_divide
from ..functions.dates import days_before, first_day_from, last_day_until
from ..star import Star

EFFECTS = ("quantityEffect", "mixEffect", "priceEffect")


def member_effects(star: Star, as_of: datetime, days: int = 30) -> DataFrame:
    """Per service and resource the change of its cost between the last ``days`` days and the
    ``days`` before, in three parts whose sum is the change:

    * quantity: what its change of quantity costs at the service's average price of before;
    * mix: that change at the difference of its own earlier price to the average;
    * price: all the rest, its quantity of now at its change of price.

    A member that was not there before is compared with the service's average price, one of a new
    service with the average of now. Rows are reduced to days, meters and resources before a
    dimension is joined; the service's averages are one more aggregate of the members.
    """
    middle, first = first_day_from(days_before(as_of, days)), first_day_from(days_before(as_of, 2 * days))
    split = star.dim_date.select("dateKey", (F.col("date") >= F.lit(middle)).alias("recent"))
    reduced = star.cost(["dateKey", "meterKey", "resourceKey", "usageQuantity", "actualCost"], since=first,
                        until=last_day_until(as_of)).groupBy("dateKey", "meterKey", "resourceKey").agg(
        F.sum("usageQuantity").alias("quantity"), F.sum("actualCost").alias("cost"))
    recent = F.col("recent")
    members = (
        reduced.join(split, "dateKey").join(star.dim_meter.select("meterKey", "serviceName"), "meterKey")
        .groupBy("serviceName", "resourceKey").agg(*[
            F.coalesce(F.sum(F.when(when, F.col(column))), F.lit(0)).cast("decimal(28,6)").alias(f"{name}{number}")
            for number, when in ((0, ~recent), (1, recent)) for column, name in (("quantity", "q"), ("cost", "c"))])
    )
    services = members.groupBy("serviceName").agg(*[F.sum(c).alias(f"all_{c}") for c in ("q0", "c0", "q1", "c1")])
    average = F.coalesce(safe_divide(F.col("all_c0"), F.col("all_q0")), safe_divide(F.col("all_c1"), F.col("all_q1")), F.lit(0.0))
    more = dbl("q1") - dbl("q0")
    own = F.coalesce(safe_divide(F.col("c0"), F.col("q0")), F.col("averagePrice"))
    change = F.col("c1") - F.col("c0")
    effects = members.join(services, "serviceName").withColumn("averagePrice", average).select(
        "serviceName", "resourceKey", F.col("c0").cast("decimal(28,2)").alias("previousCost"),
        F.col("c1").cast("decimal(28,2)").alias("currentCost"), change.cast("decimal(28,2)").alias("change"),
        (more * F.col("averagePrice")).alias("quantityEffect"), (more * (own - F.col("averagePrice"))).alias("mixEffect"))
    return effects.withColumn("priceEffect", dbl("change") - F.col("quantityEffect") - F.col("mixEffect"))


def movers_explained(star: Star, as_of: datetime, days: int = 30) -> DataFrame:
    """The same per service, with the number of members that came and went."""
    members = member_effects(star, as_of, days)
    return members.groupBy("serviceName").agg(
        *[F.sum(c).cast("decimal(28,2)").alias(c) for c in ("previousCost", "currentCost", "change")],
        *[F.sum(c).alias(c) for c in EFFECTS],
        F.count_if((F.col("previousCost") == 0) & (F.col("currentCost") != 0)).alias("membersCome"),
        F.count_if((F.col("previousCost") != 0) & (F.col("currentCost") == 0)).alias("membersGone"))
