"""Exact interpolating percentiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
#: Groups of more distinct values than that are cut into parts, at the quantiles of a sketch.
LARGE = 100_000
BUCKETS = 64


def percentiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """One row per group with a column per wanted share (0.5 is the median); NULL without values."""
    counts = df.groupBy(*keys, F.col(value).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    return percentiles_of_counts(counts, keys, "_value", "_rows", wanted)


def percentiles_of_counts(counts: DataFrame, keys: list[str], value: str, rows: str, wanted: dict[str, float],
                          large: int = LARGE) -> DataFrame:
    """The same from values and how often they occur; a value may be on several rows.

    Groups with few distinct values meet in one exchange: a window gives the rank of every value. Of
    the others a mergeable sketch gives cuts between buckets of about equal size; bucket totals tell
    in which bucket a rank lies, and only there values are ranked. So no task sorts more than a
    bucket or a small group, whatever the size of a group.
    """
    values = counts.select(F.struct(*keys).alias("_group"), F.col(value).cast("double").alias("_value"), F.col(rows).alias("_rows"))
    values = values.groupBy("_group", "_value").agg(F.sum("_rows").alias("_rows"))
    sizes = values.groupBy("_group").agg(F.count("_value").alias("_distinct"))
    many = sizes.filter(F.col("_distinct") > large).select("_group")

    group = Window.partitionBy("_group")
    small = values.join(many, "_group", "left_anti").withColumns({
        "_size": F.sum(F.when(F.col("_value").isNotNull(), F.col("_rows"))).over(group),
        "_up_to": F.sum("_rows").over(group.orderBy(F.asc_nulls_last("_value")))})
    found = _at_ranks(small, wanted).unionByName(_at_ranks(_ranked_in_buckets(values, many, wanted), wanted))
    return found.select("_group.*", *wanted)


def _ranks(wanted: dict[str, float]) -> dict[str, Column]:
    return {name: (F.col("_size") - 1) * F.lit(share) for name, share in wanted.items()}


def _at_ranks(ranked: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """Interpolate at the wanted ranks; ``_up_to`` counts the values of a group up to a row's."""
    ranks = _ranks(wanted)
    bounds = [
        F.min(F.when(F.col("_up_to") > at(rank), F.col("_value"))).alias(f"{name}{suffix}")
        for name, rank in ranks.items() for suffix, at in (("_lower", F.floor), ("_upper", F.ceil))
    ]
    between = [
        (F.col(f"{name}_lower") + (F.col(f"{name}_upper") - F.col(f"{name}_lower")) * (rank - F.floor(rank))).alias(name)
        for name, rank in ranks.items()
    ]
    return ranked.groupBy("_group").agg(F.max("_size").alias("_size"), *bounds).select("_group", *between)


def _ranked_in_buckets(values: DataFrame, groups: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """The values of ``groups`` in the buckets that hold a wanted rank, with their ranks."""
    chosen = values.join(groups, "_group", "left_semi").filter("_value IS NOT NULL")
    shares = [i / BUCKETS for i in range(1, BUCKETS)]
    sizes = chosen.groupBy("_group").agg(
        F.sum("_rows").alias("_size"), F.percentile_approx("_value", shares, SKETCH_ACCURACY).alias("_cuts"))
    placed = chosen.join(sizes, "_group").withColumn(
        "_bucket", F.size(F.filter("_cuts", lambda cut: cut < F.col("_value")))).drop("_cuts")
    totals = placed.groupBy("_group", "_bucket").agg(F.sum("_rows").alias("_total"))
    up_to = F.sum("_total").over(Window.partitionBy("_group").orderBy("_bucket"))
    totals = totals.withColumn("_before", up_to - F.col("_total"))

    def holds(rank: Column) -> Column:
        """Whether the bucket has the value of a rank, counted from 0."""
        return (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_total"))

    asked = F.lit(False)
    for rank in _ranks(wanted).values():
        asked = asked | holds(F.floor(rank)) | holds(F.ceil(rank))
    inside = Window.partitionBy("_group", "_bucket").orderBy("_value")
    return placed.join(totals, ["_group", "_bucket"]).filter(asked).withColumn(
        "_up_to", F.col("_before") + F.sum("_rows").over(inside)).select("_group", "_value", "_rows", "_size", "_up_to")


def approximate_percentiles(
    df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Same shape in one pass of bounded sketches; the rank is off by at most 1 / ``accuracy``."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(number, share, accuracy).alias(name) for name, share in wanted.items()]
    )
