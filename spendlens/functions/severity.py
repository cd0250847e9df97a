"""Severity, type and confidence of a cost deviation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity names and limits.
SEVERITIES = ("High", "Medium", "Low")
HIGH_Z = 3.0
MEDIUM_Z = 2.0
HIGH_IMPACT = 1000
MEDIUM_IMPACT = 100
FULL_CONFIDENCE_Z = 3.0


def severity_by_z(z: Column) -> Column:
    size = F.abs(z)
    return F.when(size >= HIGH_Z, "High").when(size >= MEDIUM_Z, "Medium").otherwise("Low")


def severity_by_z_and_impact(z: Column, actual: Column, expected: Column) -> Column:
    """Either an unusual z-score or a large amount of money is enough."""
    size, impact = F.abs(z), F.abs(actual - expected)
    return (
        F.when((size >= HIGH_Z) | (impact >= HIGH_IMPACT), "High")
        .when((size >= MEDIUM_Z) | (impact >= MEDIUM_IMPACT), "Medium")
        .otherwise("Low")
    )


def anomaly_type(actual: Column, expected: Column) -> Column:
    return F.when(actual > expected, "Spike").otherwise("Drop")


def confidence(z: Column) -> Column:
    return F.least(F.lit(1.0), F.abs(z) / FULL_CONFIDENCE_Z)
