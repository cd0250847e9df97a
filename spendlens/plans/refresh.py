"""Incremental refresh: how much history a table keeps and how much of it each run reloads."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, days_before, first_day_from, months_before


@dataclass(frozen=True)
class Policy:
    keep_months: int
    reload_days: int

    def keep_from(self, as_of: datetime) -> date:
        return first_day_from(months_before(as_of, self.keep_months))

    def reload_from(self, as_of: datetime) -> date:
        return first_day_from(days_before(as_of, self.reload_days))


# Months kept and days reloaded per table.
POLICIES = {
    "dim_date": Policy(13, 3),
    "fact_cost_daily": Policy(13, 3),
    "fact_utilization_daily": Policy(3, 1),
    "fact_anomaly_daily": Policy(3, 1),
}


def refreshed(stored: DataFrame, incoming: DataFrame, policy: Policy, as_of: datetime) -> DataFrame:
    """The table after a refresh: stored days inside the kept history but before the reload window,
    then the incoming days of that window. Both bounds are literals on the partition column."""
    keep, reload = date_key(policy.keep_from(as_of)), date_key(policy.reload_from(as_of))
    day = F.col("dateKey")
    return stored.filter((day >= keep) & (day < reload)).unionByName(incoming.filter(day >= reload))
