"""The calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import date_key_of


def _attributes(days: DataFrame) -> DataFrame:
    d = F.col("date")
    month_end = d == F.last_day(d)
    return days.select(
        date_key_of(d).alias("dateKey"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "yyyy-MM").alias("yearMonth"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("yearQuarter"),
        F.trunc(d, "month").alias("billingPeriodStart"),
        F.last_day(d).alias("billingPeriodEnd"),
        F.dayofweek(d).alias("dayOfWeek"),
        F.date_format(d, "EEEE").alias("dayOfWeekName"),
        F.dayofweek(d).isin(1, 7).alias("isWeekend"),
        month_end.alias("isMonthEnd"),
        (month_end & (F.month(d) % 3 == 0)).alias("isQuarterEnd"),
        (month_end & (F.month(d) == 12)).alias("isYearEnd"),
    )


def calendar_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, no gaps, with the calendar attributes."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return _attributes(days)


def calendar_of(rows: DataFrame, column: str) -> DataFrame:
    """Gap-free calendar over the days in ``rows``; ``column`` holds dates or date keys."""
    span = rows.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    if span.schema["first"].dataType.typeName() != "date":
        span = span.select(*[F.to_date(F.col(c).cast("string"), "yyyyMMdd").alias(c) for c in ("first", "last")])
    return _attributes(span.select(F.explode(F.sequence("first", "last")).alias("date")))
