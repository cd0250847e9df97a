"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions, splits skewed ones in joins and rebalanced
# writes, and turns a shuffled join into a broadcast once a side proves small. Stamps carry no time
# zone; UTC keeps conversions at the edges neutral.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Apply the settings. On a cluster give two to three shuffle partitions per core: adaptive
    execution merges those that turn out small."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder
