"""The set of tables an operator reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.columns import stamp
from .functions.dates import date_key


class Star:
    """Tables by name, as attributes. Subclasses resolve them lazily from storage."""

    def __init__(self, **tables: DataFrame):
        self.__dict__.update(tables)

    def with_tables(self, **tables: DataFrame) -> "Star":
        """A view of the same star with some tables replaced."""
        return _Overlay(self, tables)

    def as_was(self) -> "Star":
        """The same star with every resource version treated as current, so facts recorded under an
        expired version keep their resource."""
        return self.with_tables(dim_resource=self.dim_resource.withColumn("isCurrent", F.lit(True)))

    def cost(
        self, columns: Sequence[str], since: date | None = None, until: date | None = None
    ) -> DataFrame:
        """``fact_cost_daily`` between two days (both included), only ``columns``."""
        return self._between("fact_cost_daily", since, until).select(*columns)

    def utilization(self, since: date | None = None, until: date | None = None) -> DataFrame:
        return self._between("fact_utilization_daily", since, until)

    def anomalies(self, since: date | None = None, until: date | None = None) -> DataFrame:
        return self._between("fact_anomaly_daily", since, until)

    def metrics(self, since: datetime | None = None) -> DataFrame:
        """Raw metric samples that start at or after ``since``."""
        samples = self.raw_metrics_data
        return samples if since is None else samples.filter(F.col("startTime") >= stamp(since))

    def current_resources(self, *columns: str) -> DataFrame:
        """Current versions only: a fact row that points to an expired version finds no partner."""
        return self.dim_resource.filter("isCurrent").select("resourceKey", *columns)

    def _between(self, table: str, since: date | None, until: date | None) -> DataFrame:
        df = getattr(self, table)
        if since is not None:
            df = df.filter(F.col("dateKey") >= date_key(since))
        if until is not None:
            df = df.filter(F.col("dateKey") <= date_key(until))
        return df


class _Overlay(Star):
    """A star with some tables replaced; the others keep the base's own way of reading."""

    def __init__(self, base: Star, tables: dict[str, DataFrame]):
        super().__init__(**tables)
        self._base = base

    def __getattr__(self, name: str):
        return getattr(self.__dict__["_base"], name)

    def _owner(self, table: str):
        return super() if table in self.__dict__ else self._base

    def cost(self, columns, since=None, until=None):
        return self._owner("fact_cost_daily").cost(columns, since, until)

    def utilization(self, since=None, until=None):
        return self._owner("fact_utilization_daily").utilization(since, until)

    def anomalies(self, since=None, until=None):
        return self._owner("fact_anomaly_daily").anomalies(since, until)

    def metrics(self, since=None):
        return self._owner("raw_metrics_data").metrics(since)
