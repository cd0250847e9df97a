"""Resource versions out of snapshots, and the version that was valid on a fact's day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def versions_of(snapshots: DataFrame, tracked: Sequence[str]) -> DataFrame:
    """Validity intervals [validFrom, validTo) per resource out of snapshots in any order.

    ``snapshots``: resourceId, seenOn (day of the state), loadedOn (arrival), deleted, and the
    ``tracked`` attributes. A state holds until the next one seen. A late snapshot splits the interval
    it falls into; of several for one day the last to arrive counts. Equal neighbours are one
    version; a deletion ends the last one. A window holds the snapshots of one resource.
    """
    state = F.when(~F.coalesce(F.col("deleted"), F.lit(False)), F.struct(*tracked))
    seen = (
        snapshots.dropna(subset=["resourceId", "seenOn"]).groupBy("resourceId", "seenOn")
        .agg(F.max_by(F.struct(state.alias("state")), F.struct("loadedOn", F.to_json(F.struct(state)))).alias("last"))
        .select("resourceId", "seenOn", "last.state")
    )
    in_time = Window.partitionBy("resourceId").orderBy("seenOn")
    changes = seen.withColumn("same", F.col("state").eqNullSafe(F.lag("state").over(in_time)) & (F.row_number().over(in_time) > 1))
    intervals = changes.filter(~F.col("same")).withColumn("validTo", F.lead("seenOn").over(in_time))
    return intervals.filter("state IS NOT NULL").select(
        "resourceId", "state.*", F.col("seenOn").alias("validFrom"), "validTo", F.col("validTo").isNull().alias("isCurrent"))


def with_version(facts: DataFrame, versions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``facts`` (resourceId, date, ...) with ``columns`` of the version valid on their day; NULL before
    the first version, after a deletion and for unknown resources.

    The distinct days of a resource and the starts of its versions are laid out in one order, in
    which the last start before a day gives its version: no range join. A window holds at most the
    calendar and the versions of one resource, however many facts it has; the facts meet their day
    by an equality join, which adaptive execution can split.
    """
    days = facts.select("resourceId", F.col("date").alias("day")).distinct().select(
        "resourceId", "day", F.lit(1).alias("kind"), F.lit(None).alias("version"))
    starts = versions.select(
        "resourceId", F.col("validFrom").alias("day"), F.lit(0).alias("kind"), F.struct("validTo", *columns).alias("version"))
    in_time = Window.partitionBy("resourceId").orderBy("day", "kind").rowsBetween(Window.unboundedPreceding, 0)
    held = F.last("version", ignorenulls=True).over(in_time)
    valid = F.col("held.validTo").isNull() | (F.col("day") < F.col("held.validTo"))
    found = starts.unionByName(days).withColumn("held", held).filter("kind = 1").select(
        "resourceId", F.col("day").alias("date"), *[F.when(valid, F.col(f"held.{c}")).alias(c) for c in columns])
    return facts.join(found, ["resourceId", "date"], "left")
