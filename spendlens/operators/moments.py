"""Mergeable moments (count, mean, sum of squared deviations) and scores against them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOMENTS = ("days", "mean", "squares")


def moments_of(values: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Moments per member; rows without a value do not count."""
    number = F.col(value).cast("double")
    return values.groupBy(*keys).agg(
        F.count(number).alias("days"), F.coalesce(F.avg(number), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(number) * F.count(number), F.lit(0.0)).alias("squares"))


def _renamed(moments: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    return moments.select(*keys, *[F.col(c).alias(f"{c}{suffix}") for c in MOMENTS])


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def merge_expressions(n: Column, mean: Column, squares: Column, m: Column, mean2: Column, squares2: Column) -> list[Column]:
    """days, mean, squares of two disjoint sets of values together."""
    total, apart = n + m, mean2 - mean
    return [
        total.cast("long").alias("days"),
        F.when(total > 0, mean + apart * m / total).otherwise(0.0).alias("mean"),
        F.when(total > 0, squares + squares2 + apart * apart * n * m / total).otherwise(0.0).alias("squares"),
    ]


def merged(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of the values of both; members of either side."""
    both = _renamed(left, keys, "1").join(_renamed(right, keys, "2"), list(keys), "full")
    return both.select(*keys, *merge_expressions(*[_or_zero(f"{c}{side}") for side in "12" for c in MOMENTS]))


def without(whole: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of ``whole`` after the values in ``part``, which it holds, are taken out: how a day
    leaves a rolling window, or is replaced by a corrected one."""
    both = _renamed(whole, keys, "1").join(_renamed(part, keys, "2"), list(keys), "left")
    n, mean, squares, m, mean2, squares2 = [_or_zero(f"{c}{side}") for side in "12" for c in MOMENTS]
    left = n - m
    rest = F.when(left > 0, (mean * n - mean2 * m) / left).otherwise(0.0)
    apart = mean2 - rest
    return both.select(
        *keys, left.cast("long").alias("days"), rest.alias("mean"),
        F.when(left > 0, F.greatest(squares - squares2 - apart * apart * left * m / n, F.lit(0.0))).otherwise(0.0).alias("squares"))


def deviation(days: str = "days", squares: str = "squares", sample: bool = False) -> Column:
    """Population (or sample) standard deviation; NULL without enough values."""
    n = F.col(days) - (1 if sample else 0)
    return F.when(n > 0, F.sqrt(F.col(squares) / n))
