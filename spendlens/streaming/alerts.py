"""Budget alerts as a stream: the batch classification over arriving JSON events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.budget import alert_texts, classify_alerts
from ..schema import schema


def alert_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Classified alerts out of the JSON files that arrive in ``folder``. No state is kept."""
    return alert_texts(classify_alerts(spark.readStream.schema(schema("budget_alert")).json(folder)))


def run_alerts(alerts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to Parquet, each event exactly once, then stop."""
    return (
        alerts.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    )
