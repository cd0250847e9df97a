"""Every operator by name, applied to a whole star.

Rolling windows (last 30 days and the like) are part of an operator and stay. Selections that a
caller makes (one subscription, one resource, a date range) are left open: all members, all dates.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import at_hand, conform
from ..functions.dates import days_before, last_day_until
from ..functions.staging import work_folder
from ..operators import (
    anomaly, budget, costs, enrichment, insights, kpis, measures, quality, recommendations, rollup, security,
)
from ..operators.calendar import calendar_of
from ..schema import schema
from ..sources.binding import AS_OF, END, FIRST_DAY, BoundStar, metric_samples
from ..sources.exports import latest_export, read_export, write_export
from ..sources.lake import Lake, read_or_empty
from ..sources.tags import flatten_tags
from ..star import Star
from ..streaming.alerts import alert_stream, run_alerts
from ..streaming.metrics import daily_statistics, run_rollup_stream
from .features import FEATURES
from .ingest import FEW_MEMBERS, TRACKED, UNKNOWN, load_exports, resource_versions
from .refresh import POLICIES, refreshed

EXPORT_ORDER = ["Date", "SubscriptionId", "ResourceId"]
HISTORY_DAYS = (END.date() - FIRST_DAY).days


def dated_cost(star: Star, *columns: str) -> DataFrame:
    """Cost rows of the whole history with their date, current and expired resources alike."""
    return star.cost(["dateKey", *columns]).join(star.dim_date.select("dateKey", "date"), "dateKey")


def detect_over_history(star: Star) -> DataFrame:
    return anomaly.detect_anomalies(dated_cost(star, "resourceId", "subscriptionId", "actualCost"))


def _seeded(star: BoundStar) -> Star:
    return star.with_tables(fact_savings_opportunity=star.seeded_opportunities)


def _advisor_insert(star: BoundStar) -> DataFrame:
    return recommendations.advisor_insert(star, recommendations.advisor_update(_seeded(star), AS_OF))


def _utilization_upsert(star: BoundStar) -> DataFrame:
    """The last seven days merged into the utilization kept until four days ago: three days are
    updated, the rest is added."""
    source = rollup.storable(rollup.aggregate_daily_metrics(star, AS_OF))
    kept = star.utilization(until=last_day_until(days_before(AS_OF, 4)))
    return rollup.upserted(kept, source, rollup.KEYS, rollup.MEASURES)


def _tags_as_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[c for c in rows.columns if c != "tags"],
        *[F.col("tags")[name].alias(f"tag_{name}") for name in costs.TAG_COLUMNS],
    )


def _run_summary(star: Star) -> DataFrame:
    return anomaly.run_summary(dated_cost(star, "resourceId"), detect_over_history(star))


def _dim_date(star: Star) -> DataFrame:
    return calendar_of(star.cost(["dateKey"]), "dateKey")


def _measures(names: list[str], *group_by: str, **options) -> Callable[[Star], DataFrame]:
    return lambda star: measures.measures(star, names, group_by, as_of=AS_OF, **options)


def monthly_cost(star: Star) -> DataFrame:
    return (
        star.cost(["dateKey", "subscriptionKey", "actualCost"])
        .join(star.dim_date.select("dateKey", "year", "month"), "dateKey")
        .join(star.dim_subscription.select("subscriptionKey", "subscriptionId", "subscriptionName"), "subscriptionKey")
        .groupBy("subscriptionId", "subscriptionName", "year", "month").agg(F.sum("actualCost").alias("actualCost"))
    )


def alert_events(star: BoundStar) -> DataFrame:
    return budget.alerts_from_budgets(monthly_cost(star), star.budgets)


def _alert_log(star: BoundStar) -> DataFrame:
    return budget.alert_log(budget.classify_alerts(alert_events(star)), AS_OF).drop("alertId")


def _secured_cost(star: Star, *group_by: str) -> DataFrame:
    return measures.measures(star, ["Total Actual Cost", "Cost per Resource"], group_by)


def _secured_facts(star: BoundStar) -> DataFrame:
    """Rows of every secured fact, read by method and by attribute: both see the same."""
    narrow = security.secured(star, "NATION_2", ("NATION_2", "NATION_7"))
    read = {
        "cost by method": narrow.cost(["subscriptionKey"]), "cost by attribute": narrow.fact_cost_daily,
        "utilization by method": narrow.utilization(), "utilization by attribute": narrow.fact_utilization_daily,
    }
    parts = [rows.agg(F.count(F.lit(1)).alias("visibleRows")).withColumn("reading", F.lit(name)) for name, rows in read.items()]
    return reduce(DataFrame.unionByName, parts)


def _refresh_window(star: BoundStar) -> DataFrame:
    """Days kept and days reloaded: the stored copy ends before the reload window."""
    policy = POLICIES["fact_cost_daily"]
    days = ["dateKey", "resourceKey", "actualCost"]
    stored = star.cost(days).withColumn("origin", F.lit("kept"))
    incoming = star.cost(days).withColumn("origin", F.lit("reloaded"))
    return refreshed(stored, incoming, policy, AS_OF).groupBy("dateKey", "origin").agg(
        F.count(F.lit(1)).alias("costRows"), F.sum("actualCost").alias("totalCost"))


def _invoices(star: BoundStar) -> DataFrame:
    """Invoice totals out of the list price of the same lines, 5 % off."""
    return star.cost(["billingPeriodStartDate", "amortizedCost"]).groupBy("billingPeriodStartDate").agg(
        (F.sum("amortizedCost") * F.lit("0.95").cast("decimal(3,2)")).cast("decimal(18,2)").alias("invoicedAmount"))


def _export_columns(star: BoundStar, *, price_factor: str = "1.0") -> DataFrame:
    """The cost rows in the layout of an export file. To be written, they are not shuffled."""
    factor = F.lit(price_factor).cast("decimal(3,1)")
    cost = star.cost(["dateKey", "subscriptionId", "resourceId", "meterId", "billingPeriodStartDate",
                      "billingPeriodEndDate", "usageQuantity", "effectivePrice", "actualCost", "chargeType"],
                     suppliers=star.suppliers_at_hand)
    return cost.select(
        F.to_date(F.col("dateKey").cast("string"), "yyyyMMdd").alias("Date"),
        F.col("subscriptionId").alias("SubscriptionId"), F.col("resourceId").alias("ResourceId"),
        F.col("meterId").alias("MeterId"), F.col("billingPeriodStartDate").alias("BillingPeriodStartDate"),
        F.col("billingPeriodEndDate").alias("BillingPeriodEndDate"), F.col("usageQuantity").alias("Quantity"),
        F.col("effectivePrice").alias("EffectivePrice"),
        (F.col("actualCost") * factor).cast("decimal(18,2)").alias("CostInBillingCurrency"),
        F.col("chargeType").alias("ChargeType"), F.lit('{"env": "x"}').alias("Tags"),
    )


def _cost_export(star: BoundStar) -> DataFrame:
    """Two overlapping exports written and read back: the older one, with other amounts, must not
    count."""
    folder = work_folder(star.spark, "exports")
    write_export(_export_columns(star, price_factor="0.5"), f"{folder}/run=1", EXPORT_ORDER)
    write_export(_export_columns(star), f"{folder}/run=2", EXPORT_ORDER)
    rows = latest_export(read_export(star.spark, folder))
    return rows.groupBy("BillingPeriodStartDate", "SubscriptionId").agg(
        F.count(F.lit(1)).alias("costRows"), F.sum("CostInBillingCurrency").alias("cost"),
        F.sum("Quantity").alias("quantity"))


def _load_exports_fact(star: BoundStar) -> DataFrame:
    """The cost rows written as exports of two billing accounts and loaded into an empty lake. One
    account has exported twice (the older amounts must not count), the other writes its columns in
    another order; all resource groups bear one name, every tenth meter's rows name no resource."""
    folder, lake = work_folder(star.spark, "exports"), Lake(star.spark, work_folder(star.spark, "lake"))

    def export(account: int, run: str, price_factor: str = "1.0", backwards: bool = False) -> None:
        number = F.regexp_extract("SubscriptionId", r"(\d+)", 1).cast("int")
        rows = _export_columns(star, price_factor=price_factor).filter(number % 2 == account).withColumns({
            "BillingAccountId": F.lit(f"account-{account}"), "ResourceGroup": F.lit("rg"),
            "ResourceId": F.when(~F.col("MeterId").endswith("0"), F.col("ResourceId")),
        })
        columns = sorted(rows.columns, reverse=backwards)
        write_export(rows.select(columns), f"{folder}/{run}", EXPORT_ORDER)

    export(0, "run=1", price_factor="0.5")
    export(0, "run=2")
    export(1, "run=3", backwards=True)
    load_exports(lake, AS_OF, folder)
    groups = lake.read("dim_resource_group").select("resourceGroupKey", F.col("subscriptionId").alias("groupOwner"))
    named = lake.read("dim_resource").select("resourceKey", F.col("resourceId").alias("member"))
    return (
        lake.read("fact_cost_daily").join(at_hand(groups, FEW_MEMBERS), "resourceGroupKey").join(at_hand(named, FEW_MEMBERS), "resourceKey")
        .groupBy("subscriptionId", "groupOwner", "billingPeriodStartDate").agg(
            F.count(F.lit(1)).alias("costRows"), F.sum("actualCost").alias("cost"),
            F.count(F.when(F.col("member") == UNKNOWN, 1)).alias("unknownResources"))
    )


def _resource_snapshot(star: BoundStar) -> DataFrame:
    """A later state of the resources: those with a negative balance changed team."""
    suppliers = star.sample("supplier").select(
        F.concat(F.lit("/res/"), F.col("s_suppkey")).alias("resourceId"), F.col("s_acctbal"))
    tracked = [c for c in TRACKED if c in star.dim_resource.columns]
    return star.dim_resource.select("resourceId", *tracked).join(suppliers, "resourceId").withColumn(
        "team", F.when(F.col("s_acctbal") < 0, "frozen").otherwise(F.col("team"))).drop("s_acctbal")


def _resource_versions(star: BoundStar) -> DataFrame:
    stored = conform(star.dim_resource.withColumn("resourceKey", F.col("resourceKey") + 1), schema("dim_resource"))
    versions = resource_versions(stored, _resource_snapshot(star), AS_OF)
    return versions.select("resourceId", "team", "isCurrent", "effectiveStartDate", "effectiveEndDate")


def _stream_alerts(star: BoundStar) -> DataFrame:
    folder = work_folder(star.spark, "alerts")
    alert_events(star).write.json(f"{folder}/events")
    run_alerts(alert_stream(star.spark, f"{folder}/events"), f"{folder}/out", f"{folder}/state").awaitTermination()
    return star.spark.read.parquet(f"{folder}/out").select(
        "budgetName", "severity", "utilizationPercentage", "actionRequired", "ticketType", "mailSubject")


def _stream_metrics(star: BoundStar) -> DataFrame:
    """The events as a file stream, rolled up per day into a table that is read back."""
    folder = work_folder(star.spark, "metrics")
    resources = star.sample("supplier").count()
    statistics = daily_statistics(metric_samples(star.sample_stream("events"), F.lit(resources)))
    fields = star.fact_utilization_daily.schema
    run_rollup_stream(statistics, star, f"{folder}/out", fields, f"{folder}/state").awaitTermination()
    return read_or_empty(star.spark, f"{folder}/out", fields)


CATALOG: dict[str, Callable[[BoundStar], DataFrame]] = {
    "executive_kpis": lambda s: kpis.executive_kpis(s, AS_OF),
    "mom_growth": lambda s: kpis.mom_growth(s, AS_OF),
    "service_cost_breakdown": lambda s: kpis.service_cost_breakdown(s, AS_OF),
    "resource_utilization": lambda s: kpis.resource_utilization(s, AS_OF),
    "savings_opportunities": lambda s: kpis.savings_opportunities(s, AS_OF),
    "anomaly_summary": lambda s: kpis.anomaly_summary(s, AS_OF),
    "reservation_coverage": lambda s: kpis.reservation_coverage(s, AS_OF),
    "budget_vs_actual": lambda s: kpis.budget_vs_actual(s, AS_OF),
    "budget_vs_actual_with_budgets": lambda s: kpis.budget_vs_actual(s, AS_OF, s.budgets),
    "cost_advisor_recommendations": enrichment.cost_advisor_recommendations,
    "resource_utilization_metrics": lambda s: enrichment.resource_utilization_metrics(s, AS_OF),
    "daily_metrics_summary": lambda s: enrichment.daily_metrics_summary(s, AS_OF),
    "resource_utilization_sample": lambda s: enrichment.resource_utilization_sample(s, AS_OF),
    "detect_cost_anomalies": lambda s: anomaly.detect_cost_anomalies(s, AS_OF),
    "anomalies_with_previous_costs": lambda s: anomaly.with_previous_costs(
        s.fact_anomaly_daily.select("dateKey", "subscriptionKey", "actualCost", "zScore", "isAnomaly"), s, AS_OF
    ),
    "generate_rightsizing": lambda s: recommendations.generate_rightsizing(s, AS_OF),
    "process_advisor_update": lambda s: recommendations.advisor_update(_seeded(s), AS_OF),
    "process_advisor_insert": _advisor_insert,
    "aggregate_daily_metrics": lambda s: rollup.aggregate_daily_metrics(s, AS_OF),
    "utilization_upsert": _utilization_upsert,
    "cost_data": lambda s: _tags_as_columns(costs.cost_data(s, AS_OF)),
    "cost_data_by_range": lambda s: _tags_as_columns(costs.cost_data_by_range(s, FIRST_DAY, END)),
    "cost_data_by_resource": lambda s: costs.cost_data_by_resource(s, END, days_back=HISTORY_DAYS),
    "total_cost": lambda s: costs.total_cost(s, FIRST_DAY, END),
    "cost_by_service": lambda s: costs.cost_by_service(s, FIRST_DAY, END),
    "cost_by_resource_group": lambda s: costs.cost_by_resource_group(s, FIRST_DAY, END),
    "anomalous_cost_data": lambda s: costs.anomalous_cost_data(s, END, days_back=HISTORY_DAYS),
    "detect_anomalies": detect_over_history,
    "anomaly_result_records": lambda s: anomaly.result_records(detect_over_history(s), AS_OF),
    "anomaly_severity_counts": lambda s: anomaly.severity_counts(detect_over_history(s)),
    "anomaly_run_summary": _run_summary,
    "anomaly_request": lambda s: anomaly.run_detection(s, AS_OF)[1],
    "anomaly_high_severity": lambda s: anomaly.high_severity(detect_over_history(s)),
    "dim_date": _dim_date,
    "measure_cost": _measures(
        ["Total Actual Cost", "Total Amortized Cost", "Total Cost USD", "Total Usage Quantity",
         "Average Effective Price", "Cost per Resource"], "yearMonth", "subscriptionName"),
    "measure_mom": _measures(
        ["Total Actual Cost", "Previous Month Cost", "Month over Month %"], "yearMonth", "subscriptionName"),
    "measure_mom_daily": _measures(["Total Actual Cost", "Previous Month Cost"], "date", "subscriptionName"),
    "measure_mom_ratio": _measures(["Month over Month %"], "year", "businessUnit", scale=1.0),
    "measure_yoy": _measures(
        ["Total Actual Cost", "Previous Year Cost", "Year over Year %"], "yearQuarter", "businessUnit"),
    "measure_budget": _measures(
        ["Budget Amount", "Budget Remaining", "Budget Remaining %", "Budget Utilization %"],
        "yearMonth", "subscriptionName"),
    "measure_eom": _measures(["Projected EOM Spend"], "yearMonth", "subscriptionName"),
    "measure_eom_corrected": _measures(
        ["Projected EOM Spend"], "yearMonth", "subscriptionName", corrected=True, elapsed_from_data=True),
    "measure_coverage": _measures(
        ["Reservation Cost", "Savings Plan Cost", "Reservation Coverage %", "Savings Plan Coverage %"],
        "yearMonth", "businessUnit"),
    "measure_zscore": _measures(["Total Actual Cost", "Daily Z-Score"], "yearMonth", "subscriptionName"),
    "measure_utilization": _measures(
        ["Average CPU %", "Average Memory %", "Average Idle %", "Underutilized Resources", "Overutilized Resources",
         "Optimal Resources"], "businessUnit", "yearMonth"),
    "measure_utilization_percent_limits": _measures(
        ["Underutilized Resources", "Overutilized Resources", "Optimal Resources"], "team", cpu_scale=100.0),
    "measure_savings": _measures(
        ["Total Potential Monthly Savings", "Total Potential Annual Savings", "Total Realized Monthly Savings",
         "Total Realized Annual Savings", "Implementation Rate %", "Pending Opportunities",
         "High Priority Opportunities", "Completed Opportunities"], "businessUnit", "team"),
    "measure_anomalies": _measures(
        ["Total Anomalies", "High Severity Anomalies", "Medium Severity Anomalies", "Low Severity Anomalies",
         "Total Cost Variance", "Average Variance %", "Max Z-Score"], "subscriptionName"),
    "drill_date_rollup": lambda s: measures.drill(s, "calendar"),
    "drill_resource_rollup": lambda s: measures.drill(s, "ownership"),
    "rls_resource": lambda s: _secured_cost(
        security.SecuredStar(s, security.visible_resources(s, "ASIA"), None), "team", "yearMonth"),
    "rls_subscription": lambda s: _secured_cost(
        security.SecuredStar(s, None, security.visible_subscriptions(s, "user", ("NATION_1", "NATION_7"))),
        "subscriptionName", "yearMonth"),
    "rls_combined": lambda s: _secured_cost(
        security.secured(s, "NATION_2", ("NATION_2", "NATION_7")), "subscriptionName", "team"),
    "budget_alerts": lambda s: budget.classify_alerts(alert_events(s)),
    "budget_alert_texts": lambda s: budget.alert_texts(budget.classify_alerts(alert_events(s))).select(
        "budgetName", "alertMessage", "mailSubject", "ticketTitle", "mailBody"),
    "budget_alert_log": _alert_log,
    "budget_crossings": lambda s: insights.budget_crossings(s, s.budgets),
    "tags_flattened": lambda s: flatten_tags(s.sample("events").select("event_id", "event_type", "props"), tags="props"),
    "refresh_window": _refresh_window,
    "linear_forecast": lambda s: insights.linear_forecast(s, AS_OF),
    "tag_compliance": lambda s: insights.tag_compliance(s, list(costs.TAG_COLUMNS)),
    "tag_compliance_required": insights.tag_compliance,
    "unused_resources": lambda s: insights.unused_resources(s, AS_OF),
    "idle_resources": lambda s: insights.idle_resources(s, AS_OF),
    "empty_resource_groups": insights.empty_resource_groups,
    "reservation_candidates": lambda s: insights.reservation_candidates(s, AS_OF),
    "top_cost_drivers": lambda s: insights.top_cost_drivers(s, AS_OF),
    "top_movers": lambda s: insights.top_movers(s, AS_OF),
    "cost_utilization_correlation": insights.cost_utilization_correlation,
    "cost_distribution": lambda s: insights.cost_distribution(s, "businessUnit", "app", "env", "location"),
    "orphan_counts": quality.orphan_counts,
    "duplicate_cost_keys": lambda s: quality.duplicate_keys(
        s.cost(["dateKey", "resourceKey", "meterKey"]), "dateKey", "resourceKey", "meterKey"),
    "freshness": lambda s: quality.freshness(s, AS_OF),
    "completeness": quality.completeness,
    "reconciliation": lambda s: quality.reconciliation(s, _invoices(s), tolerance=0.02),
    "cost_export": _cost_export,
    "load_exports_fact": _load_exports_fact,
    "rls_fact_attributes": _secured_facts,
    "resource_versions": _resource_versions,
    "stream_budget_alerts": _stream_alerts,
    "stream_daily_metrics": _stream_metrics,
}
CATALOG |= FEATURES
