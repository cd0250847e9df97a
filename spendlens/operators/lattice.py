"""Stored roll-ups of the cost fact, and the choice of the smallest one that answers a drill."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import staged
from ..star import Star

#: The roll-ups from coarse to fine, with what they are grouped by. Each is made from the next.
LEVELS = {
    "year_unit": ["year", "businessUnit"],
    "month_subscription": ["year", "quarter", "month", "subscriptionId", "businessUnit"],
    "day_subscription": ["date", "year", "quarter", "month", "subscriptionId", "businessUnit"],
    "day_resource": ["date", "year", "quarter", "month", "subscriptionId", "businessUnit", "resourceKey"],
}
FINEST = "day_resource"
#: Size of the distinct sketches: 2**14 registers, an error of about 0.8 % (one standard deviation).
SKETCH_BITS = 14


class Lattice:
    """Tables below ``folder``: cost, rows and a mergeable sketch of the resources per group."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, level: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{level}")

    def build(self, star: Star, since: date | None = None) -> None:
        """Write all levels. With ``since`` only the fact's days from that one on are read; earlier days
        come from the finest stored level. The fact is reduced to keys before a dimension is joined,
        and every coarser level reads the one below it, never the fact."""
        reduced = star.cost(["dateKey", "subscriptionKey", "resourceKey", "actualCost"], since=since).groupBy(
            "dateKey", "subscriptionKey", "resourceKey").agg(F.sum("actualCost").alias("cost"), F.count(F.lit(1)).alias("costRows"))
        finest = (
            reduced.join(star.dim_date.select("dateKey", "date", "year", "quarter", "month"), "dateKey")
            .join(star.dim_subscription.select("subscriptionKey", "subscriptionId", "businessUnit"), "subscriptionKey")
            .groupBy(*LEVELS[FINEST]).agg(F.sum("cost").cast("decimal(28,2)").alias("cost"), F.sum("costRows").alias("costRows"),
                                          F.hll_sketch_agg("resourceKey", SKETCH_BITS).alias("resources"))
        )
        if since is not None:
            finest = staged(finest.unionByName(self.read(FINEST).filter(F.col("date") < F.lit(since))), "lattice")
        finest.write.mode("overwrite").parquet(f"{self.folder}/{FINEST}")
        below = FINEST
        for level in list(reversed(LEVELS))[1:]:
            self._rolled(self.read(below), LEVELS[level]).write.mode("overwrite").parquet(f"{self.folder}/{level}")
            below = level

    @staticmethod
    def _rolled(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.sum("cost").cast("decimal(28,2)").alias("cost"), F.sum("costRows").alias("costRows"),
            F.hll_union_agg("resources").alias("resources"))

    @staticmethod
    def level_for(columns: Sequence[str], exact: bool = False) -> str:
        """The coarsest level that has all ``columns``; exact distinct counts need the finest."""
        for level, keys in LEVELS.items():
            if set(columns) <= set(keys) and (not exact or level == FINEST):
                return level
        raise ValueError(f"no roll-up has {', '.join(columns)}")

    def drill(self, columns: Sequence[str], exact: bool = False) -> DataFrame:
        """``columns``, cost, costRows, and resources: estimated, or with ``exact`` counted."""
        level = self.level_for(columns, exact)
        rows = self.read(level)
        if exact:
            return rows.groupBy(*columns).agg(
                F.sum("cost").cast("decimal(28,2)").alias("cost"), F.sum("costRows").alias("costRows"),
                F.count_distinct("resourceKey").alias("resources"))
        found = rows if set(columns) == set(LEVELS[level]) else self._rolled(rows, columns)
        return found.select(*columns, "cost", "costRows", F.hll_sketch_estimate("resources").alias("resources"))
