"""The daily metric rollup as a stream: late samples within the watermark update their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.rollup import KEYS, MEASURES, ROLLUP_DAYS, current_key_by_id, sample_statistics, storable, utilization_columns
from ..sources.lake import merge_days
from ..star import Star


def daily_statistics(samples: DataFrame, days: int = ROLLUP_DAYS) -> DataFrame:
    """Utilization per day and resource over a stream of samples. A day stays open for ``days``
    days behind the newest sample, then its state is dropped."""
    # Watermarks need an instant, windows cut days at UTC midnight: read the wall clock as UTC.
    zone = F.current_timezone()
    wall_clock = F.from_utc_timestamp(F.col("startTime").cast("timestamp"), zone)
    statistics = sample_statistics(
        samples.withColumn("eventTime", wall_clock).withWatermark("eventTime", f"{days} days"),
        F.window("eventTime", "1 day").alias("day"), "resourceId",
    )
    date = F.to_date(F.to_utc_timestamp("day.start", zone))
    return utilization_columns(statistics, date.alias("date"), "resourceId")


def run_rollup_stream(statistics: DataFrame, star: Star, target: str, fields: StructType,
                      checkpoint: str) -> StreamingQuery:
    """Upsert every changed day into the table at ``target``. A repeated micro-batch writes the same
    values again, so recovery after a failure is harmless."""
    calendar, resources = star.dim_date.select("dateKey", "date"), current_key_by_id(star)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        rows = batch.join(calendar, "date").join(resources, "resourceId").select(*KEYS, "resourceId", *MEASURES)
        merge_days(target, fields, storable(rows), KEYS, MEASURES)

    return (
        statistics.writeStream.outputMode("update").foreachBatch(upsert)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
