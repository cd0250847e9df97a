"""Reading savings, category and priority out of an advisor recommendation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recommendation categories by a word in the type id, first match wins.
CATEGORY_WORDS = {
    "Idle": "Idle Resources",
    "RightSize": "Right Size",
    "Reserved": "Reserved Instances",
    "Spot": "Spot Instances",
    "Unattached": "Unattached Resources",
    "Premium": "Premium Tier Optimization",
}
OTHER_CATEGORY = "Other"
# Text windows of the two amount readings and the priority limits.
AMOUNT_WINDOW = 50
PRIORITY_WINDOW = 10
CRITICAL_AMOUNT = 1000
HIGH_AMOUNT = 500
MEDIUM_AMOUNT = 100


def _behind_dollar(benefits: Column, width: int) -> Column:
    return F.substr(benefits, F.instr(benefits, "$") + 1, F.lit(width))


def monthly_savings(benefits: Column) -> Column:
    """Digits and points right after the first dollar sign; 0 without one, NULL if unreadable."""
    digits = F.regexp_extract(_behind_dollar(benefits, AMOUNT_WINDOW), "^([0-9.]*)", 1)
    return F.when(benefits.contains("$"), digits.try_cast("decimal(18,2)")).otherwise(
        F.lit(0).cast("decimal(18,2)")
    )


def recommendation_category(type_id: Column) -> Column:
    chain = F
    for word, category in CATEGORY_WORDS.items():
        chain = chain.when(type_id.contains(word), category)
    return chain.otherwise(OTHER_CATEGORY)


def recommendation_priority(impact: Column, benefits: Column) -> Column:
    """Stricter reading than :func:`monthly_savings`: the ten characters behind the dollar sign
    must be a number as a whole."""
    amount = F.when(
        benefits.contains("$"), _behind_dollar(benefits, PRIORITY_WINDOW).try_cast("decimal(18,2)")
    ).otherwise(F.lit(0).cast("decimal(18,2)"))
    return (
        F.when((impact == "High") & (amount > CRITICAL_AMOUNT), "Critical")
        .when((impact == "High") | (amount > HIGH_AMOUNT), "High")
        .when((impact == "Medium") | (amount > MEDIUM_AMOUNT), "Medium")
        .otherwise("Low")
    )
