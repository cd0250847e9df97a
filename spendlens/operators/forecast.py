"""Forecast of the daily cost by trend and weekday, and its accuracy by rolling origins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, safe_divide, stamp
from ..functions.dates import days_before, first_day_from, last_day_until
from ..star import Star
from .insights import HORIZONS, Z90_ONE_SIDED, Z95

# The last origins of the backtest, days before today, and how far each looks ahead.
ORIGINS = (28, 21, 14, 7)
AHEAD_DAYS = 7
SERIES = ["subscriptionKey", "origin"]


def daily_cost(star: Star, since: date, until: date) -> DataFrame:
    """date, subscriptionKey, dailyCost."""
    return (
        star.cost(["dateKey", "subscriptionKey", "actualCost"], since=since, until=until)
        .groupBy("dateKey", "subscriptionKey").agg(F.sum("actualCost").alias("dailyCost"))
        .join(star.dim_date.select("dateKey", "date"), "dateKey").select("date", "subscriptionKey", "dailyCost")
    )


def seasonal_fit(days: DataFrame) -> DataFrame:
    """Least squares of dailyCost = slope * x + level of the weekday, x in days from ``origin``, per
    series. The slope is pooled from the sums inside the weekdays, the levels follow from their means:
    one aggregate per weekday and one per series. ``levels`` maps a weekday to its level."""
    x, y = F.date_diff("date", "origin").cast("double"), dbl("dailyCost")
    by_weekday = days.groupBy(*SERIES, F.dayofweek("date").alias("weekday")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("x"), F.avg(y).alias("y"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy"), F.regr_syy(y, x).alias("syy"))
    sums = by_weekday.groupBy(*SERIES).agg(
        F.sum("n").alias("days"), F.count(F.lit(1)).alias("weekdays"), F.sum("sxx").alias("sxx"), F.sum("sxy").alias("sxy"),
        F.sum("syy").alias("syy"), F.collect_list(F.struct("weekday", "x", "y")).alias("means"))
    fit = sums.withColumn("slope", F.coalesce(safe_divide(F.col("sxy"), F.col("sxx")), F.lit(0.0)))
    level = F.transform("means", lambda m: F.struct(m["weekday"], m["y"] - F.col("slope") * m["x"]))
    free = F.col("days") - F.col("weekdays") - 1
    residual = F.when(free > 0, F.sqrt(F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0)) / free))
    # a weekday without history takes the mean of the levels, in the order of the weekdays
    levels = F.map_from_entries(F.array_sort(level))
    mean = F.aggregate(F.array_sort(level), F.lit(0.0), lambda a, m: a + m["col2"]) / F.col("weekdays")
    return fit.select(*SERIES, "days", "slope", residual.alias("residual"), levels.alias("levels"), mean.alias("meanLevel"))


def _expected(target: Column) -> Column:
    level = F.coalesce(F.try_element_at("levels", F.dayofweek(target)), F.col("meanLevel"))
    return level + F.col("slope") * F.date_diff(target, "origin")


def backtest(star: Star, as_of: datetime, history_days: int = 90, origins: Sequence[int] = ORIGINS,
             ahead: int = AHEAD_DAYS) -> DataFrame:
    """Per subscription and origin: the forecast of the ``ahead`` days after the origin, made from the
    ``history_days`` up to it, against what was spent. Every day of the series is copied to the
    origins it serves; all fits are one aggregate."""
    today = last_day_until(as_of)
    daily = daily_cost(star, first_day_from(days_before(as_of, history_days + max(origins))), today)
    dated = daily.withColumn("origin", F.explode(F.array(*[F.date_sub(F.lit(today), o) for o in origins])))
    lag = F.date_diff("date", "origin")
    fit = seasonal_fit(dated.filter((lag <= 0) & (lag > -history_days)))
    tested = dated.filter((lag > 0) & (lag <= ahead)).join(fit.filter("residual IS NOT NULL"), SERIES)
    spent = dbl("dailyCost")
    scored = tested.withColumn("expected", _expected(F.col("date"))).groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("testedDays"), F.sum(spent).alias("actualCost"), F.sum("expected").alias("forecastedCost"),
        F.sum(F.abs(spent - F.col("expected"))).alias("absoluteError"))
    return scored.withColumn("modelAccuracy", _accuracy(F.col("absoluteError"), F.col("actualCost")))


def _accuracy(error: Column, spent: Column) -> Column:
    """100 minus the absolute error in percent of the cost, not below 0."""
    return F.greatest(F.lit(0.0), F.lit(100.0) - safe_divide(error, spent) * 100)


def seasonal_forecast(star: Star, as_of: datetime, history_days: int = 90, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Rows of ``fact_forecast_daily``: the expected cost of the day ``horizon`` days ahead with a 95 %
    band, and the accuracy over the backtest's origins (NULL where none could be tested)."""
    today = last_day_until(as_of)
    daily = daily_cost(star, first_day_from(days_before(as_of, history_days - 1)), today).withColumn("origin", F.lit(today))
    tested = backtest(star, as_of, history_days).groupBy("subscriptionKey").agg(
        _accuracy(F.sum("absoluteError"), F.sum("actualCost")).alias("modelAccuracy"))
    target = F.date_add("origin", F.col("forecastHorizonDays"))
    rows = (
        seasonal_fit(daily).filter("residual IS NOT NULL")
        .withColumn("forecastHorizonDays", F.explode(F.array(*[F.lit(h) for h in horizons])))
        .withColumn("expected", _expected(target)).join(tested, "subscriptionKey", "left")
    )
    expected, residual = F.col("expected"), F.col("residual")
    return rows.select(
        F.date_format(target, "yyyyMMdd").cast("int").alias("dateKey"), "subscriptionKey", expected.alias("forecastedCost"),
        (expected - residual * Z95).alias("confidenceIntervalLower"), (expected + residual * Z95).alias("confidenceIntervalUpper"),
        expected.alias("p50Forecast"), (expected + residual * Z90_ONE_SIDED).alias("p90Forecast"),
        F.lit("Seasonal").alias("modelType"), "modelAccuracy", "forecastHorizonDays", stamp(as_of).alias("forecastDate"))
