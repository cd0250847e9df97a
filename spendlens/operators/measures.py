"""Named measures over the star, evaluated per cell of a grouping.

A measure belongs to one fact. Every evaluation aggregates the fact to the dimension keys the
grouping needs before it touches a dimension, then joins the (left) dimensions and aggregates to
the cells. Facts without a dimension member stay under NULL attributes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dbl, mean_price, month_index, safe_divide
from ..functions.dates import last_day_of_month, months_before
from ..star import Star

# Attributes of the dimensions a fact can be grouped by.
DATE_ATTRIBUTES = ("date", "year", "quarter", "month", "yearMonth", "yearQuarter")
RESOURCE_ATTRIBUTES = (
    "resourceId", "resourceName", "resourceType", "resourceGroupName", "location", "env", "app",
    "team", "costCenter", "businessUnit",
)
SUBSCRIPTION_ATTRIBUTES = ("subscriptionId", "subscriptionName")
RELATED = {
    "cost": ("dateKey", "resourceKey", "subscriptionKey"),
    "utilization": ("dateKey", "resourceKey"),
    "savings": ("dateKey", "resourceKey"),
    "anomalies": ("dateKey", "resourceKey", "subscriptionKey"),
}
# Placeholder budget, utilization limits (shares of 1), drill paths.
BUDGET_AMOUNT = 10000
LOW_CPU = 0.20
HIGH_CPU = 0.80
DRILL_PATHS = {
    "calendar": ("year", "quarter", "month", "date"),
    "ownership": ("businessUnit", "team", "app", "resourceName"),
}


@dataclass(frozen=True)
class Part:
    """A mergeable aggregate: ``first`` over fact rows, ``again`` over partial results."""

    first: Column
    again: Callable[[str], Column]


def _sum(column: Column) -> Part:
    return Part(F.sum(column), F.sum)


def _count(column: Column) -> Part:
    return Part(F.count(column), F.sum)


def _count_where(condition: Column) -> Part:
    return Part(F.count_if(condition), F.sum)


def _max(column: Column) -> Part:
    return Part(F.max(column), F.max)


def _parts(cpu_scale: float) -> dict[str, dict[str, Part]]:
    cost, cpu = F.col("actualCost"), F.col("avgCpuPercentage")
    status, priority = F.col("status"), F.col("priority")
    flagged, severity = F.col("isAnomaly"), F.col("severity")
    return {
        "cost": {
            "actual": _sum(cost), "amortized": _sum(F.col("amortizedCost")), "usd": _sum(F.col("costInUSD")),
            "usage": _sum(F.col("usageQuantity")), "prices": _sum(F.col("effectivePrice")),
            "priced": _count(F.col("effectivePrice")),
            "reservation": _sum(F.when(F.col("isReservationCharge"), cost)),
            "savingsPlan": _sum(F.when(F.col("isSavingsPlanCharge"), cost)),
            "lastDayOfMonth": _max(F.col("dateKey") % 100),
        },
        "utilization": {
            "cpu": _sum(dbl(cpu)), "cpuRows": _count(cpu),
            "memory": _sum(dbl("avgMemoryPercentage")), "memoryRows": _count(F.col("avgMemoryPercentage")),
            "idle": _sum(dbl("idlePercentage")), "idleRows": _count(F.col("idlePercentage")),
            # A missing CPU value compares as 0, so it counts as underutilized.
            "low": _max(F.coalesce(dbl(cpu), F.lit(0.0)) < LOW_CPU * cpu_scale),
            "high": _max(dbl(cpu) > HIGH_CPU * cpu_scale),
            "fair": _max((dbl(cpu) >= LOW_CPU * cpu_scale) & (dbl(cpu) <= HIGH_CPU * cpu_scale)),
        },
        "savings": {
            "potentialMonthly": _sum(F.col("potentialMonthlySavings")),
            "potentialAnnual": _sum(F.col("potentialAnnualSavings")),
            "realizedMonthly": _sum(F.col("realizedMonthlySavings")),
            "realizedAnnual": _sum(F.col("realizedAnnualSavings")),
            "pending": _count_where(status == "Pending"), "highPriority": _count_where(priority == "High"),
            "completed": _count_where(status == "Completed"),
        },
        "anomalies": {
            "flagged": _count_where(flagged),
            "flaggedHigh": _count_where(flagged & (severity == "High")),
            "flaggedMedium": _count_where(flagged & (severity == "Medium")),
            "flaggedLow": _count_where(flagged & (severity == "Low")),
            "variance": _sum(F.col("costVariance")), "percentages": _sum(F.col("variancePercentage")),
            "percentageRows": _count(F.col("variancePercentage")), "topZ": _max(F.col("zScore")),
        },
    }


@dataclass(frozen=True)
class Measure:
    """``parts`` are merged sums, ``distinct`` partial flags counted per resource, ``shift`` a month
    offset, ``daily`` asks for the spread of day totals; ``formula`` combines them."""

    fact: str
    formula: Callable[..., Column]
    parts: tuple[str, ...] = ()
    distinct: str | None = None
    shift: int = 0
    daily: bool = False


def _of(fact: str, part: str) -> Measure:
    return Measure(fact, lambda c, o: c(part), (part,))


def _mean(fact: str, total: str, rows: str) -> Measure:
    return Measure(fact, lambda c, o: safe_divide(c(total), c(rows)), (total, rows))


def _share(fact: str, part: str, whole: str) -> Measure:
    return Measure(fact, lambda c, o: safe_divide(c(part), c(whole)) * o.scale, (part, whole))


def _growth(months: int) -> Measure:
    def formula(c, o):
        return safe_divide(c("actual") - c("earlier"), c("earlier")) * o.scale

    return Measure("cost", formula, ("actual",), shift=months)


def _budget(c, o) -> Column:
    return dbl(c("budgetAmount")) if isinstance(o.budget, DataFrame) else F.lit(float(o.budget))


def _remaining(c, o) -> Column:
    return _budget(c, o) - F.coalesce(dbl(c("actual")), F.lit(0.0))


def _projected(c, o) -> Column:
    """Literal form: the factor is the difference in length between this month and the last one;
    ``corrected`` uses the number of days of this month."""
    this_month = last_day_of_month(o.as_of)
    days = this_month if o.corrected else this_month - last_day_of_month(months_before(o.as_of, 1))
    elapsed = dbl(c("lastDayOfMonth")) if o.elapsed_from_data else F.lit(float(o.as_of.day))
    return safe_divide(c("actual"), elapsed) * days


# Measure names.
MEASURES: Mapping[str, Measure] = {
    "Total Actual Cost": _of("cost", "actual"),
    "Total Amortized Cost": _of("cost", "amortized"),
    "Total Cost USD": _of("cost", "usd"),
    "Total Usage Quantity": _of("cost", "usage"),
    "Average Effective Price": Measure(
        "cost", lambda c, o: mean_price(c("prices"), c("priced")), ("prices", "priced")),
    "Previous Month Cost": Measure("cost", lambda c, o: c("earlier"), ("actual",), shift=1),
    "Month over Month %": _growth(1),
    "Previous Year Cost": Measure("cost", lambda c, o: c("earlier"), ("actual",), shift=12),
    "Year over Year %": _growth(12),
    "Budget Amount": Measure("cost", _budget, ("actual",)),
    "Budget Remaining": Measure("cost", _remaining, ("actual",)),
    "Budget Remaining %": Measure("cost", lambda c, o: safe_divide(_remaining(c, o), _budget(c, o)), ("actual",)),
    "Budget Utilization %": Measure("cost", lambda c, o: safe_divide(c("actual"), _budget(c, o)) * o.scale, ("actual",)),
    "Projected EOM Spend": Measure("cost", _projected, ("actual", "lastDayOfMonth")),
    "Reservation Cost": _of("cost", "reservation"),
    "Savings Plan Cost": _of("cost", "savingsPlan"),
    "Reservation Coverage %": _share("cost", "reservation", "actual"),
    "Savings Plan Coverage %": _share("cost", "savingsPlan", "actual"),
    "Cost per Resource": Measure("cost", lambda c, o: safe_divide(c("actual"), c("resources")), ("actual",), distinct="any"),
    "Daily Z-Score": Measure("cost", lambda c, o: safe_divide(dbl(c("actual")) - c("dayMean"), c("daySpread")), ("actual",), daily=True),
    "Average CPU %": _mean("utilization", "cpu", "cpuRows"),
    "Average Memory %": _mean("utilization", "memory", "memoryRows"),
    "Average Idle %": _mean("utilization", "idle", "idleRows"),
    "Underutilized Resources": Measure("utilization", lambda c, o: c("resources_low"), distinct="low"),
    "Overutilized Resources": Measure("utilization", lambda c, o: c("resources_high"), distinct="high"),
    "Optimal Resources": Measure("utilization", lambda c, o: c("resources_fair"), distinct="fair"),
    "Total Potential Monthly Savings": _of("savings", "potentialMonthly"),
    "Total Potential Annual Savings": _of("savings", "potentialAnnual"),
    "Total Realized Monthly Savings": _of("savings", "realizedMonthly"),
    "Total Realized Annual Savings": _of("savings", "realizedAnnual"),
    "Implementation Rate %": _share("savings", "realizedMonthly", "potentialMonthly"),
    "Pending Opportunities": _of("savings", "pending"),
    "High Priority Opportunities": _of("savings", "highPriority"),
    "Completed Opportunities": _of("savings", "completed"),
    "Total Anomalies": _of("anomalies", "flagged"),
    "High Severity Anomalies": _of("anomalies", "flaggedHigh"),
    "Medium Severity Anomalies": _of("anomalies", "flaggedMedium"),
    "Low Severity Anomalies": _of("anomalies", "flaggedLow"),
    "Total Cost Variance": _of("anomalies", "variance"),
    "Average Variance %": _mean("anomalies", "percentages", "percentageRows"),
    "Max Z-Score": _of("anomalies", "topZ"),
}


@dataclass(frozen=True)
class Options:
    """``budget`` is one amount for every cell, or a frame of some ``group_by`` columns and
    ``budgetAmount``. ``scale`` 100 gives percentages, 1 plain ratios; ``cpu_scale`` 1 keeps the
    limits as shares, 100 compares them with percentages. The projection of the month uses
    ``as_of``; ``corrected`` counts the days of the month, ``elapsed_from_data`` divides by the
    last day with cost."""

    as_of: datetime | None = None
    budget: float | DataFrame = float(BUDGET_AMOUNT)
    scale: float = 100.0
    cpu_scale: float = 1.0
    corrected: bool = False
    elapsed_from_data: bool = False


def _rows(star: Star, fact: str) -> DataFrame:
    if fact == "cost":
        return star.cost(
            ["dateKey", "resourceKey", "subscriptionKey", "actualCost", "amortizedCost", "costInUSD",
             "usageQuantity", "effectivePrice", "isReservationCharge", "isSavingsPlanCharge"]
        )
    if fact == "savings":
        return star.fact_savings_opportunity
    return star.utilization() if fact == "utilization" else star.anomalies()


def _key_of(attribute: str) -> str | None:
    for key, attributes in (("dateKey", DATE_ATTRIBUTES), ("resourceKey", RESOURCE_ATTRIBUTES),
                            ("subscriptionKey", SUBSCRIPTION_ATTRIBUTES)):
        if attribute in attributes:
            return key
    return None


def _attached(df: DataFrame, star: Star, attributes: Sequence[str]) -> DataFrame:
    """Left-join the dimensions that hold ``attributes``."""
    for key, dimension in (("dateKey", "dim_date"), ("resourceKey", "dim_resource"),
                           ("subscriptionKey", "dim_subscription")):
        wanted = [a for a in attributes if _key_of(a) == key]
        if wanted:
            df = df.join(getattr(star, dimension).select(key, *wanted), key, "left")
    return df


def _partial(star: Star, fact: str, parts: Mapping[str, Part], attributes: Sequence[str],
             extra_keys: Sequence[str] = ()) -> DataFrame:
    """The fact aggregated to the dimension keys of ``attributes``, dimensions attached."""
    own = [a for a in attributes if _key_of(a) is None]
    keys = sorted({_key_of(a) for a in attributes} - {None} | set(extra_keys))
    missing = set(keys) - set(RELATED[fact])
    if missing:
        raise ValueError(f"{fact} is not related to {sorted(missing)}")
    partial = _rows(star, fact).groupBy(*keys, *own).agg(*[p.first.alias(n) for n, p in parts.items()])
    return _attached(partial, star, attributes)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` where two NULLs are equal."""
    if not keys:
        return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(renamed, condition, "left").drop(*[f"_{k}" for k in keys])


def _shifted(star: Star, months: int, group_by: Sequence[str], where: Mapping[str, Sequence]) -> DataFrame:
    """Total cost of the cells ``months`` earlier, filed under the current cells. Single days
    compare with the same day of the earlier month, larger cells with whole months."""
    actual = {"actual": _parts(1.0)["cost"]["actual"]}
    others = [a for a in group_by if a not in DATE_ATTRIBUTES]

    def totals(*dates: str) -> DataFrame:
        attributes = list(dict.fromkeys([*dates, *others, *where]))
        return _filtered(_partial(star, "cost", actual, attributes), where).groupBy(*dates, *others)

    if "date" in group_by:
        days = totals("date").agg(F.sum("actual").alias("earlier"))
        calendar = star.dim_date.select(*[a for a in DATE_ATTRIBUTES if a in group_by])
        moved = days.withColumnRenamed("date", "_from")
        return calendar.join(moved, F.add_months(calendar["date"], -months) == moved["_from"]).drop("_from")
    monthly = totals("year", "month").agg(F.sum("actual").alias("actual"))
    index = month_index(F.col("year"), F.col("month")) + (months - 1)
    moved = monthly.withColumn("_index", index).drop("year", "month")
    first_day = F.make_date(F.floor(F.col("_index") / 12).cast("int"), (F.col("_index") % 12 + 1).cast("int"), F.lit(1))
    named = moved.withColumn("_day", first_day).select(
        *others, "actual",
        F.year("_day").alias("year"), F.quarter("_day").alias("quarter"), F.month("_day").alias("month"),
        F.date_format("_day", "yyyy-MM").alias("yearMonth"),
        F.concat(F.year("_day").cast("string"), F.lit("-Q"), F.quarter("_day").cast("string")).alias("yearQuarter"),
    )
    return named.groupBy(*group_by).agg(F.sum("actual").alias("earlier"))


def _spread(star: Star, group_by: Sequence[str], where: Mapping[str, Sequence]) -> DataFrame:
    """Mean and population deviation of the day totals inside each cell."""
    actual = {"actual": _parts(1.0)["cost"]["actual"]}
    attributes = list(dict.fromkeys([*group_by, *where, "date"]))
    days = _filtered(_partial(star, "cost", actual, attributes), where)
    per_day = days.groupBy(*dict.fromkeys([*group_by, "date"])).agg(F.sum("actual").cast("double").alias("dayTotal"))
    return per_day.groupBy(*group_by).agg(
        F.avg("dayTotal").alias("dayMean"), F.stddev_pop("dayTotal").alias("daySpread"))


def _filtered(df: DataFrame, where: Mapping[str, Sequence]) -> DataFrame:
    for attribute, members in where.items():
        df = df.filter(F.col(attribute).isin(*members))
    return df


def measures(
    star: Star, names: Sequence[str], group_by: Sequence[str] = (), where: Mapping[str, Sequence] | None = None,
    **options,
) -> DataFrame:
    """Measures of one fact, one row per cell of ``group_by``.

    ``where`` keeps the listed members of an attribute. Options: see :class:`Options`.
    """
    chosen = {name: MEASURES[name] for name in names}
    facts = {m.fact for m in chosen.values()}
    if len(facts) != 1:
        raise ValueError("measures of one call must share a fact")
    fact, where, option = facts.pop(), dict(where or {}), Options(**options)
    group_by = list(group_by)
    shifts = {m.shift for m in chosen.values() if m.shift}
    if shifts and set(where) & set(DATE_ATTRIBUTES):
        raise ValueError("group by a date attribute instead of filtering it when comparing periods")

    known = _parts(option.cpu_scale)[fact]
    flags = {m.distinct for m in chosen.values() if m.distinct}
    needed = {p for m in chosen.values() for p in m.parts}
    parts = {p: known[p] for p in known if p in needed or p in flags}
    attributes = list(dict.fromkeys([*group_by, *where]))
    partial = _partial(star, fact, parts, attributes, ["resourceKey"] if flags else [])
    aggregates = [parts[p].again(p).alias(p) for p in parts if p in needed]
    for flag in flags:
        if flag == "any":
            aggregates.append(F.count_distinct("resourceKey").alias("resources"))
        else:
            aggregates.append(F.count_distinct(F.when(F.col(flag), F.col("resourceKey"))).alias(f"resources_{flag}"))
    cells = _filtered(partial, where).groupBy(*group_by).agg(*aggregates)

    if isinstance(option.budget, DataFrame):
        cells = _same(cells, option.budget, [c for c in option.budget.columns if c != "budgetAmount"])
    if any(m.daily for m in chosen.values()):
        cells = _same(cells, _spread(star, group_by, where), group_by)
    for months in sorted(shifts):
        if not set(group_by) & set(DATE_ATTRIBUTES):
            raise ValueError("a period comparison needs a date attribute in group_by")
        earlier = _shifted(star, months, group_by, where).withColumnRenamed("earlier", f"earlier_{months}")
        cells = _same(cells, earlier, group_by)

    def columns(months: int):
        return lambda part: F.col(f"earlier_{months}" if part == "earlier" else part)

    return cells.select(*group_by, *[m.formula(columns(m.shift), option).alias(name) for name, m in chosen.items()])


def measure(star: Star, name: str, group_by: Sequence[str] = (), **options) -> DataFrame:
    return measures(star, [name], group_by, **options)


def drill(star: Star, path: str) -> DataFrame:
    """Total cost with a subtotal for every level of a drill path; ``level`` counts the attributes
    that are set (0 is the grand total)."""
    attributes = list(DRILL_PATHS[path])
    actual = {"actual": _parts(1.0)["cost"]["actual"]}
    leaves = _partial(star, "cost", actual, attributes).groupBy(*attributes).agg(F.sum("actual").alias("actual"))
    set_attributes = sum((1 - F.grouping(a) for a in attributes), F.lit(0))
    return leaves.rollup(*attributes).agg(
        set_attributes.cast("int").alias("level"), F.sum("actual").alias("totalCost"))
