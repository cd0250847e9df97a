"""Reading utilization out of raw metric samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import dbl

# Metric names, units, namespaces and sampling intervals.
CPU = "Percentage CPU"
FREE_MEMORY = "Available Memory Bytes"
BYTES = "Bytes"
NAMESPACES = {
    "Microsoft.Compute/virtualMachines": "Virtual Machine",
    "Microsoft.Web/sites": "App Service",
    "Microsoft.Sql/servers": "SQL Database",
    "Microsoft.Storage/storageAccounts": "Storage Account",
    "Microsoft.Network/loadBalancers": "Load Balancer",
}
GRAIN_MINUTES = {"PT1M": 1, "PT5M": 5, "PT15M": 15, "PT1H": 60}
DEFAULT_GRAIN_MINUTES = 60


def is_cpu() -> Column:
    return F.col("metricName") == CPU


def is_free_memory() -> Column:
    return (F.col("metricName") == FREE_MEMORY) & (F.col("unit") == BYTES)


def memory_percentage() -> Column:
    """Used share of the total named in the dimensions; NULL unless that total is positive."""
    whole = F.get_json_object("dimensions", "$.TotalMemory").try_cast("decimal(18,0)")
    return F.when(whole > 0, (dbl(whole) - dbl("metricValue")) / dbl(whole) * 100)


def utilization_percentage() -> Column:
    raw = dbl("metricValue")
    return F.when(is_cpu(), raw).when(is_free_memory(), memory_percentage()).otherwise(raw)


def resource_type(namespace: Column) -> Column:
    chain = F
    for name, kind in NAMESPACES.items():
        chain = chain.when(namespace == name, kind)
    return chain.otherwise(namespace)


def grain_rank(grain: Column) -> Column:
    """Place of a code in text order among the known codes: odd for a known code, even for a code
    between two of them. The largest code of a group has the largest rank, and a maximum over
    numbers keeps the aggregation hash-based."""
    rank = F.lit(0)
    for code in GRAIN_MINUTES:
        rank = rank + F.when(grain > code, 2).when(grain == code, 1).otherwise(0)
    return F.when(grain.isNotNull(), rank)


def grain_hours(largest_rank: Column) -> Column:
    """Hours per sample for the largest code of a group, given by its rank."""
    chain = F
    for place, code in enumerate(sorted(GRAIN_MINUTES)):
        chain = chain.when(largest_rank == 2 * place + 1, GRAIN_MINUTES[code] / 60)
    return chain.otherwise(DEFAULT_GRAIN_MINUTES / 60)
