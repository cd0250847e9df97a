"""Anomaly detection that reads one day at a time and keeps moments between the runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import dbl, ratio_or_zero
from ..functions.dates import date_key
from ..functions.severity import anomaly_type, severity_by_z
from ..operators.anomaly import MIN_COST, Z_THRESHOLD
from ..operators.moments import deviation, merge_expressions
from ..sources.lake import read_or_empty
from ..star import Star

_STATE = """subscriptionKey int, actualCost decimal(28,2), daysBefore bigint, meanBefore double,
    squaresBefore double, days bigint, mean double, squares double"""


class DailyMoments:
    """One small table per day below ``folder``: every subscription's cost of the day, its moments
    before and after it. A run reads the day's cost rows (the bound reaches the scan) and the table
    of the day before; repeating it, or a later day, writes the same again."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, day: date) -> str:
        return f"{self.folder}/dateKey={date_key(day)}"

    def apply(self, star: Star, day: date, before: date | None) -> None:
        """Score and merge ``day``; ``before`` is the last day applied (None: nothing yet)."""
        key, names = "subscriptionKey", ("days", "mean", "squares")
        known = read_or_empty(self.spark, self._path(before) if before else f"{self.folder}/none", _STATE)
        today = star.cost(["dateKey", key, "actualCost"], since=day, until=day)
        # one row per subscription from before, any number from today: one aggregate brings them together
        rows = known.select(key, *names, F.lit(None).alias("actualCost")).unionByName(
            today.select(key, "actualCost"), allowMissingColumns=True)
        n, mean, squares = (F.col(f"{c}Before") for c in names)
        spent, one = F.coalesce(dbl("actualCost"), F.lit(0.0)), F.when(F.col("actualCost").isNotNull(), 1).otherwise(0)
        rows.groupBy(key).agg(
            F.sum("actualCost").cast("decimal(28,2)").alias("actualCost"),
            *[F.coalesce(F.max(c), F.lit(0)).cast("bigint" if c == "days" else "double").alias(f"{c}Before") for c in names],
        ).select(
            key, "actualCost", *[f"{c}Before" for c in names], *merge_expressions(n, mean, squares, one, spent, F.lit(0.0)),
        ).write.mode("overwrite").parquet(self._path(day))

    def moments(self, day: date) -> DataFrame:
        """subscriptionKey, days, mean, squares after ``day``."""
        return read_or_empty(self.spark, self._path(day), _STATE).select(
            "subscriptionKey", "days", "mean", "squares")

    def scores(self, z: float = Z_THRESHOLD, min_cost: float = MIN_COST) -> DataFrame:
        """Every day applied against the days before it: the row a day got when it was applied."""
        rows = self.spark.read.schema(f"{_STATE}, dateKey int").parquet(self.folder).filter("actualCost IS NOT NULL AND daysBefore > 0")
        spent, expected = dbl("actualCost"), F.col("meanBefore")
        score = ratio_or_zero(spent - expected, deviation("daysBefore", "squaresBefore"))
        return rows.withColumn("zScore", score).select(
            "dateKey", "subscriptionKey", "actualCost", expected.alias("expectedCost"),
            (spent - expected).alias("costVariance"), "zScore", F.col("daysBefore").alias("days"),
            anomaly_type(spent, expected).alias("anomalyType"), severity_by_z(F.col("zScore")).alias("severity"),
            ((F.abs("zScore") >= z) & (spent >= min_cost)).alias("isAnomaly"))
