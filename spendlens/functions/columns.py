"""Small column expressions used by several operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dbl(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision; 0 when the denominator is missing or not positive."""
    return F.when(denominator > 0, dbl(numerator) / dbl(denominator)).otherwise(F.lit(0.0))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision; NULL when the denominator is missing or 0."""
    return F.try_divide(dbl(numerator), dbl(denominator))


def mean_price(sum_: Column, rows: Column) -> Column:
    """Average of exact prices, kept exact up to the six decimals of a price."""
    return F.try_divide(sum_, rows.cast("decimal(18,0)")).cast("decimal(18,6)")


def total(column: str) -> Column:
    return F.sum(column).alias(column)


def month_index(year: Column, month: Column) -> Column:
    """Months since year 0: consecutive calendar months differ by exactly 1."""
    return year * 12 + month


def date_key_of(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def stamp(moment: datetime) -> Column:
    """A literal without time zone, independent of machine and session zones."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def text(column: str) -> Column:
    """Missing text becomes the empty string at the service boundary."""
    return F.coalesce(F.col(column), F.lit(""))


def at_hand(table: DataFrame, most: int) -> DataFrame:
    """``table``, broadcast to joins if it has at most ``most`` rows, so that the other side, which is
    far longer, is not shuffled."""
    return F.broadcast(table) if table.count() <= most else table


def conform(df: DataFrame, schema) -> DataFrame:
    """Project ``df`` onto a table's StructType: cast each field, NULL where it is absent."""
    have = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
