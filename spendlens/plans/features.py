"""Registered queries of versions, incremental detection, forecasts, commitments, idle runs and
budget crossings as a stream."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import last_day_until
from ..functions.staging import staged, work_folder
from ..operators import (
    anomaly, attribution, commitment, forecast, idle, lattice, measures, movers, quality, recommendations, versions,
)
from ..sources.binding import AS_OF, BoundStar
from ..sources.exports import layout_drift, write_export
from ..streaming.crossings import crossings, run_crossings
from .incremental import DailyMoments
from .jobs import publish_anomalies

DETECTION_DAYS = 30


def resource_snapshots(star: BoundStar) -> DataFrame:
    """States of the resources in the order in which they arrive: the first ones, later moves, a late
    state between both, the first state seen again, and deletions."""
    key = F.col("resourceKey")

    def state(number: int, which: Column, since: date, spread: Column, team: Column, deleted: bool = False) -> DataFrame:
        return star.dim_resource.filter(which).select(
            "resourceId", F.date_add(F.lit(since), spread.cast("int")).alias("seenOn"), F.lit(number).alias("loadedOn"),
            F.lit(deleted).alias("deleted"), team.alias("team"), "env")

    every, team = F.lit(True), F.col("team")
    parts = [
        state(1, every, date(1995, 1, 1), key % 400, team),
        state(2, key % 3 == 0, date(1997, 1, 1), key * 7 % 900, F.concat(F.lit("moved-"), key % 5)),
        state(3, key % 4 == 0, date(1996, 1, 1), key * 3 % 300, F.concat(F.lit("late-"), key % 2)),
        state(4, key % 5 == 0, date(1998, 6, 1), F.lit(0), team),
        state(5, key % 11 == 0, date(2000, 1, 1), key % 100, team, deleted=True),
    ]
    return reduce(DataFrame.unionByName, parts)


def facts_by_version(star: BoundStar) -> DataFrame:
    """Cost per team that a resource belonged to on the day; every fourth line is filed under one
    resource."""
    held = versions.versions_of(resource_snapshots(star), ["team", "env"])
    line = star.sample("lineitem").select(
        F.when(F.col("l_linenumber") == 1, "/res/1").otherwise(F.concat(F.lit("/res/"), "l_suppkey")).alias("resourceId"),
        F.to_date("l_shipdate").alias("date"), F.col("l_quantity").cast("decimal(18,2)").alias("quantity"))
    return versions.with_version(line, held, ["team", "env"]).groupBy(
        "team", "env", F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("costRows"), F.sum("quantity").alias("quantity"))


def resource_intervals(star: BoundStar) -> DataFrame:
    return versions.versions_of(resource_snapshots(star), ["team", "env"])


def incremental_detection(star: BoundStar) -> DataFrame:
    """The last thirty days, one at a time: each run reads its day and the moments so far. The last
    day is run again, as after a failure."""
    store = DailyMoments(star.spark, work_folder(star.spark, "moments"))
    today = last_day_until(AS_OF)
    days = [today - timedelta(days=n) for n in range(DETECTION_DAYS - 1, -1, -1)]
    for before, day in zip([None, *days], days):
        store.apply(star, day, before)
    store.apply(star, days[-1], days[-2])
    return store.scores()


def stream_crossings(star: BoundStar) -> DataFrame:
    """Cost rows arrive in two deliveries, the second of which repeats a part of the first and brings
    rows of months long past; the stream is stopped between them and goes on from its checkpoint, and
    is started once more with nothing new."""
    spark, folder = star.spark, work_folder(star.spark, "crossings")
    line = star.sample("lineitem")
    rows = line.join(star.sample("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date"),
                    F.col("l_extendedprice").cast("decimal(18,2)")).alias("rowId"),
        F.concat(F.lit("sub-"), "s_nationkey").alias("subscriptionId"), F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"), F.col("l_extendedprice").cast("decimal(18,2)").alias("cost"), "l_linenumber")
    fields = rows.drop("l_linenumber").schema
    budgets = staged(star.budgets, "budgets")

    def deliver(which: Column) -> None:
        rows.filter(which).drop("l_linenumber").write.mode("append").parquet(f"{folder}/in")

    def run() -> None:
        stream = spark.readStream.schema(fields).option("maxFilesPerTrigger", 64).parquet(f"{folder}/in")
        run_crossings(stream, budgets, folder).awaitTermination()

    deliver(F.col("l_linenumber") <= 3)
    run()
    deliver(F.col("l_linenumber") >= 3)
    run()
    run()
    return crossings(spark, folder).groupBy("subscriptionId", "year", "month", "threshold", "budgetAmount").agg(
        F.count(F.lit(1)).alias("announcements"))


def export_drift(star: BoundStar) -> DataFrame:
    """Three exports written one after the other: the second lacks the tags, the third has prices that
    are no numbers and a column that nobody declared."""
    folder = work_folder(star.spark, "exports")
    cost = star.cost(["dateKey", "subscriptionId", "meterId", "usageQuantity", "effectivePrice"], suppliers=star.suppliers_at_hand)
    rows = cost.select(
        F.to_date(F.col("dateKey").cast("string"), "yyyyMMdd").alias("Date"), F.col("subscriptionId").alias("SubscriptionId"),
        F.col("meterId").alias("MeterId"), F.col("usageQuantity").alias("Quantity"),
        F.col("effectivePrice").cast("string").alias("EffectivePrice"), F.lit("a\nb").alias("Tags"))
    broken = F.when(F.col("MeterId").endswith("7"), "n/a").otherwise(F.col("EffectivePrice"))
    layouts = [rows, rows.drop("Tags"), rows.withColumns({"EffectivePrice": broken, "Discount": F.lit(0)})]
    for number, layout in enumerate(layouts, 1):
        write_export(layout, f"{folder}/run={number}")
    found = layout_drift(star.spark, folder, rows.columns)
    return found.withColumn("exportFolder", F.element_at(F.split("exportFolder", "/"), -1))


def account_completeness(star: BoundStar) -> DataFrame:
    day = F.to_date(F.col("dateKey").cast("string"), "yyyyMMdd")
    number = F.regexp_extract("subscriptionId", r"(\d+)", 1).cast("int")
    rows = star.cost(["dateKey", "subscriptionId", "billingPeriodStartDate", "billingPeriodEndDate"]).select(
        F.concat(F.lit("account-"), number % 5).alias("BillingAccountId"), day.alias("Date"),
        F.col("billingPeriodStartDate").alias("BillingPeriodStartDate"), F.col("billingPeriodEndDate").alias("BillingPeriodEndDate"))
    return quality.account_completeness(rows)


def member_effects(star: BoundStar) -> DataFrame:
    return movers.member_effects(star, AS_OF)


def resumed_detection(star: BoundStar) -> DataFrame:
    """What a run adds when all days but the last week are scored already."""
    stored = staged(star.fact_anomaly_daily, "anomalies")
    return anomaly.detect_cost_anomalies(star, AS_OF, existing=stored.filter("dateKey <= 20010725"))


def resumed_rightsizing(star: BoundStar) -> DataFrame:
    """What a run adds when resources with an even key have an open recommendation."""
    stored = staged(star.seeded_opportunities, "opportunities")
    return recommendations.generate_rightsizing(star, AS_OF, existing=stored.filter("resourceKey % 2 = 0"))


def repeated_advisor(star: BoundStar) -> DataFrame:
    """Status and type of the opportunities after two advisor runs in a row: the second adds nothing."""
    stored = star.with_tables(fact_savings_opportunity=star.seeded_opportunities)
    for _ in range(2):
        updated = staged(recommendations.advisor_update(stored, AS_OF), "opportunities")
        added = recommendations.advisor_insert(stored, updated)
        stored = star.with_tables(fact_savings_opportunity=staged(
            updated.unionByName(added, allowMissingColumns=True), "opportunities"))
    return stored.fact_savings_opportunity.groupBy("recommendationType", "status").agg(
        F.count(F.lit(1)).alias("opportunities"), F.sum("potentialMonthlySavings").alias("potentialMonthlySavings"))


def scaled_detection(star: BoundStar) -> DataFrame:
    """Detection over small amounts with a low limit: spikes and drops, every severity."""
    cost = star.cost(["dateKey", "resourceId", "subscriptionId", "actualCost"]).join(
        star.dim_date.select("dateKey", "date"), "dateKey")
    thousandth = (F.col("actualCost") / 1000).cast("decimal(18,5)")
    return anomaly.detect_anomalies(cost.withColumn("actualCost", thousandth), z=1.0, min_cost=0.0)


def published_records(star: BoundStar) -> DataFrame:
    """The findings written as JSON lines and read back."""
    folder = publish_anomalies(scaled_detection(star), work_folder(star.spark, "published"), AS_OF)
    fields = """resource_id string, subscription_id string, date string, actual_cost decimal(18,5), expected_cost double,
        variance double, variance_percentage double, z_score double, anomaly_type string, severity string, is_anomaly boolean,
        confidence double, detected_at string"""
    return star.spark.read.schema(fields).json(folder)


def realized_savings(star: BoundStar) -> DataFrame:
    """Savings measures where every third resource has done what was recommended."""
    done = F.col("resourceKey") % 3 == 0
    monthly = (F.col("potentialMonthlySavings") * F.lit("0.8").cast("decimal(2,1)")).cast("decimal(18,2)")
    changed = star.fact_savings_opportunity.withColumns({
        "status": F.when(done, "Completed").otherwise(F.col("status")),
        "realizedMonthlySavings": F.when(done, monthly).otherwise(F.col("realizedMonthlySavings")),
        "realizedAnnualSavings": F.when(done, (monthly * 12).cast("decimal(18,2)")).otherwise(F.col("realizedAnnualSavings"))})
    return measures.measures(
        star.with_tables(fact_savings_opportunity=changed),
        ["Total Realized Monthly Savings", "Total Realized Annual Savings", "Implementation Rate %", "Pending Opportunities",
         "Completed Opportunities"], ["team"], as_of=AS_OF)


def flagged_measures(star: BoundStar) -> DataFrame:
    """Anomaly measures over the flagged days only, whose variance does not cancel."""
    flagged = star.with_tables(fact_anomaly_daily=star.fact_anomaly_daily.filter("isAnomaly"))
    return measures.measures(flagged, ["Total Anomalies", "Total Cost Variance", "Average Variance %", "Max Z-Score"],
                             ["subscriptionName"], as_of=AS_OF)


def lattice_drill(star: BoundStar) -> DataFrame:
    """Drills of every depth out of the stored roll-ups, the last month of which is loaded again. The
    sketch's count of resources must be within 3 % of the exact one."""
    stored = lattice.Lattice(star.spark, work_folder(star.spark, "lattice"))
    stored.build(star)
    stored.build(star, since=date(2001, 10, 1))
    drills = (["businessUnit"], ["year", "businessUnit"], ["year", "quarter", "subscriptionId"], ["date"], ["date", "subscriptionId"])
    parts = []
    for columns in drills:
        exact = stored.drill(columns, exact=True).select(*columns, F.col("resources").alias("exact"))
        near = F.abs(F.col("resources") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.03)
        name = F.lit(f"{stored.level_for(columns)}: {', '.join(columns)}").alias("drill")
        member = F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).alias("member")
        parts.append(stored.drill(columns).join(exact, columns).select(
            name, member, "cost", "costRows", F.col("exact").alias("resources"), near.alias("sketchWithin")))
    return reduce(DataFrame.unionByName, parts)


def variance_by_cell(star: BoundStar) -> DataFrame:
    return attribution.variance_by_cell(star, star.fact_anomaly_daily, AS_OF)


FEATURES: dict[str, Callable[[BoundStar], DataFrame]] = {
    "resource_intervals": resource_intervals,
    "facts_by_version": facts_by_version,
    "incremental_detection": incremental_detection,
    "seasonal_forecast": lambda s: forecast.seasonal_forecast(s, AS_OF),
    "forecast_backtest": lambda s: forecast.backtest(s, AS_OF),
    "purchase_quantity": lambda s: commitment.purchase_quantity(s, AS_OF),
    "idle_runs": lambda s: idle.idle_runs(s, min_idle=50.0, min_days=2),
    "stream_crossings": stream_crossings,
    "movers_explained": lambda s: movers.movers_explained(s, AS_OF),
    "movers_explained_members": member_effects,
    "export_drift": export_drift,
    "account_completeness": account_completeness,
    "detect_cost_anomalies_resumed": resumed_detection,
    "generate_rightsizing_resumed": resumed_rightsizing,
    "advisor_repeated": repeated_advisor,
    "detect_anomalies_scaled": scaled_detection,
    "anomaly_records_published": published_records,
    "measure_savings_realized": realized_savings,
    "measure_anomalies_flagged": flagged_measures,
    "lattice_drill": lattice_drill,
    "variance_by_cell": variance_by_cell,
}
