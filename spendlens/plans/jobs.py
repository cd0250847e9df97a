"""Write jobs. Each returns the number of rows it wrote and may be repeated: a second run with the
same input changes nothing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import stamp
from ..functions.dates import date_key, days_before, first_day_from
from ..functions.staging import staged
from ..operators import anomaly, insights, recommendations, rollup
from ..sources.lake import Lake, LakeStar
from .refresh import POLICIES, refreshed


def _created(rows: DataFrame, as_of: datetime) -> DataFrame:
    return rows.withColumn("rowCreatedDate", stamp(as_of))


def run_detection(lake: Lake, as_of: datetime, z: float = anomaly.Z_THRESHOLD,
                  min_cost: float = anomaly.MIN_COST) -> int:
    """Append the subscription-days of the last 30 days that are not scored yet."""
    star = LakeStar(lake)
    since = first_day_from(days_before(as_of, anomaly.DETECTION_DAYS))
    rows = anomaly.detect_cost_anomalies(star, as_of, z, min_cost, existing=star.anomalies(since=since))
    return lake.append("fact_anomaly_daily", _created(rows, as_of))


def run_rightsizing(lake: Lake, as_of: datetime, one_per_resource: bool = False) -> int:
    star = LakeStar(lake)
    rows = recommendations.generate_rightsizing(
        star, as_of, existing=star.fact_savings_opportunity, one_per_resource=one_per_resource)
    return lake.append("fact_savings_opportunity", _created(rows, as_of))


def run_advisor(lake: Lake, as_of: datetime) -> tuple[int, int]:
    """(rows of the updated version, rows added). The new rows are chosen against the updated
    version, whatever the update changed."""
    star = LakeStar(lake)
    updated = lake.replace("fact_savings_opportunity", recommendations.advisor_update(star, as_of))
    star = LakeStar(lake)
    rows = recommendations.advisor_insert(star, star.fact_savings_opportunity)
    return updated, lake.append("fact_savings_opportunity", _created(storable_opportunities(rows), as_of))


def storable_opportunities(rows: DataFrame) -> DataFrame:
    """Both keys are mandatory in the fact."""
    return rows.dropna(subset=["dateKey", "resourceKey"])


def run_rollup(lake: Lake, as_of: datetime) -> int:
    """Re-aggregate the last seven days of samples, late ones included, into utilization."""
    rows = rollup.storable(rollup.aggregate_daily_metrics(LakeStar(lake), as_of))
    return lake.upsert("fact_utilization_daily", _created(rows, as_of), rollup.KEYS, rollup.MEASURES)


def run_forecast(lake: Lake, as_of: datetime) -> int:
    """Forecast rows by target day, subscription and horizon; a later forecast of the same day and
    horizon replaces the earlier one."""
    rows = _created(insights.linear_forecast(LakeStar(lake), as_of), as_of)
    keys = ["dateKey", "subscriptionKey", "forecastHorizonDays"]
    return lake.upsert("fact_forecast_daily", rows, keys, [c for c in rows.columns if c not in keys])


def run_refresh(lake: Lake, table: str, incoming: DataFrame, as_of: datetime) -> int:
    """Replace the days of the table's reload window by ``incoming``: a day that it lacks goes, and
    so do the days before the kept history."""
    since, keep = (date_key(day) for day in (POLICIES[table].reload_from(as_of), POLICIES[table].keep_from(as_of)))
    written = lake.replace(table, incoming.filter(F.col("dateKey") >= since), only_after=since)
    lake.drop_days(table, [day for day in lake.days(table) if day < keep])
    return written


def publish_refreshed(lake: Lake, table: str, incoming: DataFrame, as_of: datetime, path: str) -> None:
    """Write the kept history plus the reloaded days as a table of its own for a report."""
    rows = refreshed(lake.read(table), incoming, POLICIES[table], as_of)
    rows.hint("rebalance", "dateKey").write.mode("overwrite").partitionBy("dateKey").parquet(path)


def publish_anomalies(anomalies: DataFrame, folder: str, as_of: datetime) -> str:
    """JSON lines below a stamped folder; returns the folder."""
    target = f"{folder.rstrip('/')}/anomalies/anomaly-results-{as_of:%Y%m%d-%H%M%S}"
    records = anomaly.result_records(anomalies, as_of)
    records.write.mode("overwrite").option("ignoreNullFields", False).json(target)
    return target


def run_detection_request(lake: Lake, as_of: datetime, subscription_id: str,
                          days_back: int = anomaly.DETECTION_DAYS) -> dict[str, DataFrame | str]:
    """Detect for one subscription, publish the findings, and return summary, alert counts and the
    high-severity list as frames."""
    subscription = anomaly.require_subscription(subscription_id)
    cost, found = anomaly.run_detection(LakeStar(lake), as_of, subscription, days_back)
    found = staged(found, "anomalies")
    return {
        "results": publish_anomalies(found, lake.root, as_of),
        "summary": anomaly.run_summary(cost, found, days_back),
        "alerts": anomaly.severity_counts(found),
        "high_severity": anomaly.high_severity(found),
    }


def daily_chain(lake: Lake, as_of: datetime) -> dict[str, int]:
    """Samples to utilization to recommendations, then detection; each step reads what the one
    before has written."""
    written = {"utilization": run_rollup(lake, as_of), "rightsizing": run_rightsizing(lake, as_of)}
    written["updated"], written["advised"] = run_advisor(lake, as_of)
    written["anomalies"] = run_detection(lake, as_of)
    return written
