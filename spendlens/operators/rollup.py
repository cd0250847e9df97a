"""Daily rollup of raw metric samples into utilization rows, and the upsert of the result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, safe_divide
from ..functions.dates import days_before
from ..functions.metrics import grain_hours, grain_rank, is_cpu, is_free_memory, memory_percentage
from ..star import Star

# Lookback, idle shares by CPU level, availability placeholder.
ROLLUP_DAYS = 7
IDLE_BY_CPU = {5: 95.0, 20: 80.0, 50: 50.0}
IDLE_OTHERWISE = 10.0
AVAILABILITY = 95.0

KEYS = ["dateKey", "resourceKey"]
MEASURES = [
    "avgCpuPercentage", "maxCpuPercentage", "avgMemoryPercentage", "maxMemoryPercentage",
    "avgDiskIOPS", "maxDiskIOPS", "avgNetworkIOPS", "maxNetworkIOPS",
    "uptimeHours", "idlePercentage", "availabilityPercentage",
]


def sample_statistics(samples: DataFrame, *keys) -> DataFrame:
    """One conditional aggregation over the samples; the grouping columns are the caller's.

    Averages of exact decimals are kept as sum and count, so they do not depend on row order.
    """
    value = F.col("metricValue")
    totals = F.col("aggregationType") == "Total"
    selected = {
        "Cpu": F.when(is_cpu(), value),
        "Disk": F.when(F.col("metricName").contains("Disk") & totals, value),
        "Network": F.when(F.col("metricName").contains("Network") & totals, value),
    }
    memory = F.when(is_free_memory(), memory_percentage())
    aggregates = [F.avg(memory).alias("avgMemory"), F.max(memory).alias("maxMemory"),
                  F.max(grain_rank(F.col("timeGrain"))).alias("grainRank")]
    for name, column in selected.items():
        aggregates += [F.sum(column).alias(f"sum{name}"), F.max(column).alias(f"max{name}"),
                       F.count(column).alias(f"count{name}")]
    return samples.groupBy(*keys).agg(*aggregates)


def utilization_columns(statistics: DataFrame, *keys) -> DataFrame:
    """Turn the aggregates into the columns of ``fact_utilization_daily``."""
    cpu = safe_divide(F.col("sumCpu"), F.col("countCpu"))
    idle = F
    for limit, share in IDLE_BY_CPU.items():
        idle = idle.when(cpu < limit, share)
    return statistics.select(
        *keys,
        cpu.alias("avgCpuPercentage"), dbl("maxCpu").alias("maxCpuPercentage"),
        F.col("avgMemory").alias("avgMemoryPercentage"), F.col("maxMemory").alias("maxMemoryPercentage"),
        safe_divide(F.col("sumDisk"), F.col("countDisk")).alias("avgDiskIOPS"), dbl("maxDisk").alias("maxDiskIOPS"),
        safe_divide(F.col("sumNetwork"), F.col("countNetwork")).alias("avgNetworkIOPS"),
        dbl("maxNetwork").alias("maxNetworkIOPS"),
        (F.col("countCpu") * grain_hours(F.col("grainRank"))).alias("uptimeHours"),
        idle.otherwise(IDLE_OTHERWISE).alias("idlePercentage"),
        F.lit(AVAILABILITY).alias("availabilityPercentage"),
    )


def current_key_by_id(star: Star) -> DataFrame:
    """One current surrogate key per resource id (the smallest)."""
    return (
        star.dim_resource.filter("isCurrent").groupBy("resourceId")
        .agg(F.min("resourceKey").alias("resourceKey"))
    )


def aggregate_daily_metrics(star: Star, as_of: datetime, days: int | None = ROLLUP_DAYS) -> DataFrame:
    """Utilization per day and resource over the last ``days`` days; ``None`` covers all history.

    A day outside the calendar or a resource without a current version gives a NULL key.
    """
    samples = star.metrics(since=None if days is None else days_before(as_of, days)).withColumn(
        "date", F.to_date("startTime")
    )
    rows = utilization_columns(sample_statistics(samples, "date", "resourceId"), "date", "resourceId")
    return (
        rows.join(star.dim_date.select("dateKey", "date"), "date", "left")
        .join(current_key_by_id(star), "resourceId", "left")
        .select(*KEYS, "resourceId", *MEASURES)
    )


def storable(rows: DataFrame) -> DataFrame:
    """Rows the fact can hold: both keys are mandatory there, so a resource without a current
    version has no row."""
    return rows.dropna(subset=KEYS)


def upserted(target: DataFrame, source: DataFrame, keys: list[str], updated: list[str]) -> DataFrame:
    """``target`` after a merge with ``source`` (one row per key): matched rows take the
    ``updated`` columns, others are added. Columns missing in ``source`` start as NULL."""
    incoming = source.withColumn("_incoming", F.lit(True))
    known = target.withColumn("_known", F.lit(True))
    s, t = incoming.alias("s"), known.alias("t")
    matched = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    joined = t.join(s, matched, "full_outer")
    arrives, present = F.col("s._incoming").isNotNull(), F.col("t._known").isNotNull()

    def pick(name: str):
        old = F.col(f"t.{name}")
        if name not in source.columns:
            return old
        new = F.col(f"s.{name}").cast(target.schema[name].dataType)
        if name in updated:
            return F.when(arrives, new).otherwise(old)
        return F.when(present, old).otherwise(new)

    return joined.select([pick(c).alias(c) for c in target.columns])
