"""Small hand-made stars."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from spendlens.functions.dates import date_key
from spendlens.operators.calendar import calendar_between
from spendlens.schema import schema
from spendlens.star import Star

NOW = datetime(2024, 3, 15)


def table(spark, name, rows):
    """Rows given as dicts; missing columns are NULL, numbers become decimals where declared."""
    fields = schema(name)

    def value(field, row):
        v = row.get(field.name)
        return Decimal(str(v)) if v is not None and field.dataType.typeName() == "decimal" else v

    return spark.createDataFrame([tuple(value(f, row) for f in fields.fields) for row in rows], fields)


def cost_row(day: date, cost, resource=1, subscription=1, meter=1, **more):
    return {
        "dateKey": date_key(day), "resourceKey": resource, "subscriptionKey": subscription, "meterKey": meter,
        "resourceId": f"/res/{resource}", "subscriptionId": f"sub-{subscription}", "actualCost": cost,
        "amortizedCost": cost, "costInUSD": cost, "usageQuantity": 1, "effectivePrice": cost,
        "isReservationCharge": False, "isSavingsPlanCharge": False, **more,
    }


def small_star(spark, cost=(), utilization=(), savings=(), anomalies=(), metrics=(), advice=(), benefits=(),
               resources=None):
    resources = resources or [
        {"resourceKey": 1, "resourceId": "/res/1", "resourceName": "one", "businessUnit": "Retail", "team": "red", "isCurrent": True},
        {"resourceKey": 2, "resourceId": "/res/2", "resourceName": "two", "businessUnit": "Retail", "team": "blue", "isCurrent": True},
        {"resourceKey": 3, "resourceId": "/res/1", "resourceName": "one", "businessUnit": "Bank", "team": "red", "isCurrent": False},
    ]
    return Star(
        dim_date=calendar_between(spark, date(2023, 1, 1), date(2024, 12, 31)),
        dim_resource=table(spark, "dim_resource", resources),
        dim_subscription=table(spark, "dim_subscription", [
            {"subscriptionKey": 1, "subscriptionId": "sub-1", "subscriptionName": "Dev", "businessUnit": "Retail"},
            {"subscriptionKey": 2, "subscriptionId": "sub-2", "subscriptionName": "Prod"},
        ]),
        dim_meter=table(spark, "dim_meter", [
            {"meterKey": 1, "meterId": "m1", "serviceName": "Compute", "meterCategory": "VM"},
            {"meterKey": 2, "meterId": "m2", "serviceName": "Storage", "meterCategory": "Disk"},
        ]),
        dim_benefit=table(spark, "dim_benefit", list(benefits)),
        fact_cost_daily=table(spark, "fact_cost_daily", list(cost)),
        fact_utilization_daily=table(spark, "fact_utilization_daily", list(utilization)),
        fact_savings_opportunity=table(spark, "fact_savings_opportunity", list(savings)),
        fact_anomaly_daily=table(spark, "fact_anomaly_daily", list(anomalies)),
        raw_metrics_data=table(spark, "raw_metrics_data", list(metrics)),
        raw_advisor_recommendations=table(spark, "raw_advisor_recommendations", list(advice)),
    )


def by(df, *keys):
    """Collected rows by key value(s)."""
    rows = df.select("*").collect()
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}


def sample(resource, metric, value, start=datetime(2024, 3, 14, 8), grain="PT1H", unit="Percent", kind="Average",
           dimensions=None, **more):
    return {"id": "x", "resourceId": resource, "metricName": metric, "metricNamespace": "Microsoft.Web/sites",
            "timeGrain": grain, "aggregationType": kind, "startTime": start, "endTime": start, "metricValue": value,
            "unit": unit, "dimensions": dimensions, "subscriptionId": "sub-1", "resourceGroup": "rg", **more}


def rounded(column):
    return F.round(column, 6)
