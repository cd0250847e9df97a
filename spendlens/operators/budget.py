"""Budget alerts: classification, texts and the log record. Every function is a stateless
projection, so it serves batch and stream alike."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, safe_divide
from ..schema import schema

# Required fields, limits, names and texts of an alert.
REQUIRED = ("budgetName", "threshold", "currentSpend", "budgetAmount", "subscriptionId")
HIGH_SHARE = 0.9
MEDIUM_SHARE = 0.75
ACTION_EXCEEDED = "IMMEDIATE ACTION REQUIRED: Budget exceeded!"
ACTION_HIGH = "URGENT: Budget at 90%+ utilization"
ACTION_MEDIUM = "WARNING: Budget at 75%+ utilization"
ACTION_LOW = "INFO: Budget threshold reached"
CARD_COLORS = {"High": "Attention", "Medium": "Warning", "Low": "Good"}
IMPORTANCE = {"High": "High", "Medium": "Normal", "Low": "Normal"}
TICKET_TYPES = {"High": "Bug", "Medium": "Task", "Low": "Task"}
TICKET_PRIORITIES = {"High": "1", "Medium": "2", "Low": "3"}
RECOMMENDED_ACTIONS = (
    "Review recent cost changes in the Azure portal",
    "Check for new or modified resources",
    "Consider implementing cost controls",
    "Review reserved instances and savings plans",
)
DASHBOARD_URL = (
    "https://portal.azure.com/#view/Microsoft_Azure_CostManagement/Menu/~/overview/subscription/"
)


def accepted(alerts: DataFrame) -> DataFrame:
    """Alerts with every required field."""
    return alerts.dropna(subset=list(REQUIRED))


def rejected(alerts: DataFrame) -> DataFrame:
    missing = F.lit(False)
    for name in REQUIRED:
        missing = missing | F.col(name).isNull()
    return alerts.filter(missing)


def alert_severity(spend: Column, budget: Column) -> Column:
    return (
        F.when(spend > budget * HIGH_SHARE, "High").when(spend > budget * MEDIUM_SHARE, "Medium").otherwise("Low")
    )


def required_action(spend: Column, budget: Column) -> Column:
    return (
        F.when(spend > budget, ACTION_EXCEEDED)
        .when(spend > budget * HIGH_SHARE, ACTION_HIGH)
        .when(spend > budget * MEDIUM_SHARE, ACTION_MEDIUM)
        .otherwise(ACTION_LOW)
    )


def _by_severity(mapping: dict[str, str]) -> Column:
    chain = F
    for severity, value in mapping.items():
        chain = chain.when(F.col("severity") == severity, value)
    return chain.otherwise(None)


def number_text(number: Column) -> Column:
    """Plain digits, up to six decimals, without trailing zeros."""
    return F.regexp_replace(number.cast("decimal(28,6)").cast("string"), r"\.?0+$", "")


def _or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _lines(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def classify_alerts(alerts: DataFrame) -> DataFrame:
    """Accepted alerts with severity, utilization, required action and ticket attributes."""
    spend, budget = dbl("currentSpend"), dbl("budgetAmount")
    return (
        accepted(alerts)
        .withColumn("severity", alert_severity(spend, budget))
        .withColumn("utilizationPercentage", safe_divide(spend * 100, budget))
        .withColumn("actionRequired", required_action(spend, budget))
        .withColumns({
            "cardColor": _by_severity(CARD_COLORS),
            "importance": _by_severity(IMPORTANCE),
            "ticketType": _by_severity(TICKET_TYPES),
            "ticketPriority": _by_severity(TICKET_PRIORITIES),
        })
    )


def alert_texts(classified: DataFrame) -> DataFrame:
    """Message, mail subject, mail body and ticket title."""
    spend, budget = number_text(F.col("currentSpend")), number_text(F.col("budgetAmount"))
    used = number_text(F.col("utilizationPercentage"))
    message = _lines(
        "🚨 Budget Alert: ", F.col("budgetName"), "\n\nSubscription: ", _or_empty("subscriptionName"),
        "\nCurrent Spend: $", spend, "\nBudget Amount: $", budget, "\nThreshold: ", F.col("threshold"),
        "%\nTime: ", _or_empty("timeGenerated"), "\n\nBudget utilization: ", used, "%",
    )
    title = _lines("Budget Alert: ", F.col("budgetName"), " - ", _or_empty("subscriptionName"))
    actions = "".join(f"<li>{action}</li>" for action in RECOMMENDED_ACTIONS)
    body = _lines(
        "<h2>", F.col("actionRequired"), "</h2><br><br>", F.replace(F.col("alertMessage"), F.lit("\n"), F.lit("<br>")),
        f'<br><br><h3>Recommended Actions:</h3><ul>{actions}</ul><br><p><a href="{DASHBOARD_URL}',
        F.col("subscriptionId"), '">View Cost Analysis Dashboard</a></p>',
    )
    return (
        classified.withColumn("alertMessage", message)
        .withColumn("mailSubject", _lines("[", F.col("severity"), "] ", title))
        .withColumn("ticketTitle", title)
        .withColumn("mailBody", body)
    )


def alert_log(classified: DataFrame, logged_at: datetime) -> DataFrame:
    """The record kept per alert."""
    return classified.select(
        F.uuid().alias("alertId"), F.lit(logged_at.isoformat()).alias("timestamp"),
        "budgetName", "subscriptionId", "subscriptionName", "currentSpend", "budgetAmount", "threshold",
        "severity", "utilizationPercentage", "actionRequired",
    )


def alerts_from_budgets(monthly_cost: DataFrame, budgets: DataFrame, threshold: str = "90") -> DataFrame:
    """Alert events: one per budgeted month with cost. ``monthly_cost`` holds subscriptionId,
    subscriptionName, year, month, actualCost."""
    month = F.format_string("%04d-%02d", "year", "month")
    events = monthly_cost.join(budgets, ["subscriptionId", "year", "month"]).select(
        _lines("budget-", F.col("subscriptionId"), "-", month).alias("budgetName"),
        F.lit(threshold).alias("threshold"),
        dbl("actualCost").alias("currentSpend"), dbl("budgetAmount").alias("budgetAmount"),
        "subscriptionId", "subscriptionName", _lines(month, "-01T00:00:00").alias("timeGenerated"),
    )
    return events.select(*schema("budget_alert").fieldNames())
