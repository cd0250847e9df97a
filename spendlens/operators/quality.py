"""Health of the stored data: keys, freshness, completeness, schema and reconciliation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import safe_divide
from ..star import Star

# The foreign keys of the cost fact.
COST_REFERENCES = {
    "dateKey": "dim_date",
    "resourceKey": "dim_resource",
    "subscriptionKey": "dim_subscription",
    "resourceGroupKey": "dim_resource_group",
    "regionKey": "dim_region",
    "meterKey": "dim_meter",
    "offerKey": "dim_offer",
    "benefitKey": "dim_benefit",
}


def orphan_counts(star: Star) -> DataFrame:
    """Cost rows whose key has no dimension member, per foreign key. One fact pass: the keys are
    counted first, only distinct keys meet a dimension."""
    keys = star.cost(list(COST_REFERENCES)).select(
        F.explode(F.create_map(*[e for k in COST_REFERENCES for e in (F.lit(k), F.col(k))])).alias("keyName", "keyValue")
    ).filter("keyValue IS NOT NULL").groupBy("keyName", "keyValue").agg(F.count(F.lit(1)).alias("factRows"))
    members = None
    for key, dimension in COST_REFERENCES.items():
        part = getattr(star, dimension).select(F.lit(key).alias("keyName"), F.col(key).alias("keyValue"))
        members = part if members is None else members.unionByName(part)
    checked = keys.join(members.withColumn("known", F.lit(True)), ["keyName", "keyValue"], "left")
    return checked.groupBy("keyName").agg(
        F.sum("factRows").alias("factRows"),
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("factRows"))).alias("orphans"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def freshness(star: Star, as_of: datetime) -> DataFrame:
    """Latest cost day per subscription and its age in days."""
    return (
        star.cost(["dateKey", "subscriptionKey"]).groupBy("subscriptionKey").agg(F.max("dateKey").alias("dateKey"))
        .join(star.dim_date.select("dateKey", "date"), "dateKey")
        .join(star.dim_subscription.select("subscriptionKey", "subscriptionId"), "subscriptionKey")
        .select("subscriptionId", F.col("date").alias("latestDate"),
                F.date_diff(F.lit(as_of.date()), F.col("date")).alias("ageDays"))
    )


def completeness(star: Star) -> DataFrame:
    """Per month: calendar days, days with cost and rows, between the first and the last cost day."""
    days = star.cost(["dateKey"]).groupBy("dateKey").agg(F.count(F.lit(1)).alias("costRows"))
    first, last = days.agg(F.min("dateKey")).scalar(), days.agg(F.max("dateKey")).scalar()
    expected = star.dim_date.select("dateKey", "yearMonth").filter(F.col("dateKey").between(first, last))
    return (
        expected.join(days, "dateKey", "left").groupBy("yearMonth")
        .agg(F.count(F.lit(1)).alias("calendarDays"), F.count("costRows").alias("costDays"),
             F.coalesce(F.sum("costRows"), F.lit(0)).alias("costRows"))
    )


def account_completeness(rows: DataFrame) -> DataFrame:
    """Per billing account and period: the days expected, from the first of the period to its end or
    to the account's newest day, and the days and rows delivered. ``rows``: BillingAccountId, Date,
    BillingPeriodStartDate, BillingPeriodEndDate of export rows."""
    days = rows.groupBy("BillingAccountId", "BillingPeriodStartDate", "BillingPeriodEndDate", "Date").agg(
        F.count(F.lit(1)).alias("costRows"))
    newest = days.groupBy("BillingAccountId").agg(F.max("Date").alias("newest"))
    periods = days.groupBy("BillingAccountId", "BillingPeriodStartDate", "BillingPeriodEndDate").agg(
        F.count("Date").alias("deliveredDays"), F.sum("costRows").alias("costRows"))
    expected = F.date_diff(F.least("BillingPeriodEndDate", "newest"), F.col("BillingPeriodStartDate")) + 1
    return periods.join(newest, "BillingAccountId").select(
        "BillingAccountId", "BillingPeriodStartDate", expected.alias("expectedDays"), "deliveredDays",
        (expected - F.col("deliveredDays")).alias("missingDays"), "costRows")


def schema_drift(found: StructType, expected: StructType) -> list[tuple[str, str]]:
    """(column, problem) pairs: missing, unexpected or of another type."""
    have = {f.name: f.dataType for f in found.fields}
    want = {f.name: f.dataType for f in expected.fields}
    drift = [(name, "missing") for name in want if name not in have]
    drift += [(name, "unexpected") for name in have if name not in want]
    drift += [
        (name, f"{have[name].simpleString()} instead of {want[name].simpleString()}")
        for name in want if name in have and have[name] != want[name]
    ]
    return drift


def reconciliation(star: Star, invoices: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Cost per billing month against invoices (billingPeriodStartDate, invoicedAmount)."""
    billed = star.cost(["billingPeriodStartDate", "actualCost"]).groupBy("billingPeriodStartDate").agg(
        F.sum("actualCost").alias("loadedCost"))
    both = billed.join(invoices, "billingPeriodStartDate", "full_outer").na.fill({"loadedCost": 0, "invoicedAmount": 0})
    difference = F.col("loadedCost") - F.col("invoicedAmount")
    share = safe_divide(F.abs(difference), F.col("invoicedAmount"))
    return both.select(
        "billingPeriodStartDate", "loadedCost", "invoicedAmount", difference.alias("difference"),
        (F.coalesce(share, F.when(difference == 0, 0.0).otherwise(1.0)) <= tolerance).alias("reconciled"))
