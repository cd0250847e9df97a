"""Budget thresholds crossed by a stream of cost rows, each announced once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.insights import BUDGET_THRESHOLDS
from ..sources.lake import read_or_empty

PERIOD = ["subscriptionId", "year", "month"]
_STATE = "subscriptionId string, year int, month int, spent decimal(28,2), announced int"
_CROSSED = """subscriptionId string, year int, month int, threshold int, budgetAmount decimal(18,2),
    spent decimal(28,2), batch bigint"""


def run_crossings(rows: DataFrame, budgets: DataFrame, folder: str,
                  thresholds: Sequence[int] = BUDGET_THRESHOLDS) -> StreamingQuery:
    """Announce thresholds as cost ``rows`` (rowId, subscriptionId, year, month, cost) arrive.

    A row that was delivered before is dropped by its rowId, in keyed state on disk without expiry, so
    late rows of any age count, once. What has been spent and the highest threshold announced are
    kept per budget and period: a batch sums its rows (partial sums in the tasks, so a hot
    subscription is no burden), adds them to the state of the batch before and announces what lies
    between the old and the new total. State and announcements of a batch are written to folders of
    its number: a batch that is repeated after a failure writes the same again. A correction that
    lowers the total takes nothing back and does not announce again what was announced.
    """
    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = read_or_empty(session, f"{folder}/state/batch={number - 1}", _STATE)
        added = batch.groupBy(*PERIOD).agg(F.sum("cost").alias("added"))
        limits = F.array(*[F.lit(t) for t in sorted(thresholds)])
        spent = (F.coalesce("spent", F.lit(0)) + F.coalesce("added", F.lit(0))).cast("decimal(28,2)")
        budgeted = F.col("budgetAmount") > 0
        reached = F.greatest(F.lit(0), *[
            F.when(budgeted & (spent * 100 >= F.col("budgetAmount") * t), t).otherwise(0) for t in thresholds])
        after = before.join(added, PERIOD, "full").join(budgets.select(*PERIOD, "budgetAmount"), PERIOD, "left").select(
            *PERIOD, spent.alias("spent"), F.coalesce("announced", F.lit(0)).alias("told"), "budgetAmount",
            F.greatest(F.coalesce("announced", F.lit(0)), reached).cast("int").alias("announced"))
        after.write.mode("overwrite").parquet(f"{folder}/state/batch={number}")
        held = session.read.parquet(f"{folder}/state/batch={number}").filter("announced > told")
        held.withColumn("threshold", F.explode(F.filter(limits, lambda t: (t > F.col("told")) & (t <= F.col("announced"))))).select(
            *PERIOD, "threshold", "budgetAmount", "spent").write.mode("overwrite").parquet(f"{folder}/crossed/batch={number}")

    return (
        rows.dropDuplicates(["rowId"]).writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


def crossings(spark: SparkSession, folder: str) -> DataFrame:
    """Everything announced so far, with the total at that moment and the number of the batch."""
    return read_or_empty(spark, f"{folder}/crossed", _CROSSED)
