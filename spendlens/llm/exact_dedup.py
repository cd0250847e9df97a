"""Exact deduplication as a stream with keyed state on disk.

Arrivals (digest, identifier, content locator) are folded into a streaming aggregate whose state is
kept by digest in RocksDB and in the checkpoint, without expiry. It holds the largest identifier so
far, the locator of its text (file and row) and the number of arrivals. A later run over the same
``folder`` reads only what has arrived since. The state is read back as a table, with which every
row meets its digest.

A hit, a digest that came more than once, is not believed: the full texts of its rows are compared.
Equal texts are pre-aggregated in each task, so a text with a third of all rows crosses the network
once per task. A digest with one text is settled; one with several (a collision) is grouped by the
texts themselves.

Null counts as empty. Texts are equal if identical without any change. Of rows that share text and
the largest identifier, the last by locator stays; a null identifier counts as smallest. Extra
columns are ignored. Only DataFrame operations run on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.staging import staged, work_folder

#: State in RocksDB; without files allocated ahead, since there are many small stores.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
#: Digests of hits that are broadcast (64 bytes each) to pick the rows to compare.
BROADCAST_HITS = 500_000
ARRIVAL = "digest string, doc_id bigint, file string, row bigint"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _located(docs: DataFrame) -> DataFrame:
    """doc_id, text and the place of every row: the file it lies in and its number there."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *place)
    except AnalysisException:  # not a plain scan of files
        return staged(wanted, "content").select("doc_id", "text", *place)


def _holder() -> Column:
    return F.max(F.struct("doc_id", "file", "row"))


def fold(arrivals: str, checkpoint: str, spark: SparkSession) -> DataFrame:
    """Fold what is new in the folder of arrivals into the keyed state and return the state:
    digest, holder (doc_id, file, row), size."""
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        stream = spark.readStream.schema(ARRIVAL).parquet(arrivals)
        query = (stream.groupBy("digest").agg(_holder().alias("holder"), F.count(F.lit(1)).alias("size"))
                 .writeStream.outputMode("update").format("noop").trigger(availableNow=True)
                 .option("checkpointLocation", checkpoint).start())
        query.awaitTermination()
        return _read_state(spark, checkpoint)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    state = spark.read.format("statestore").load(checkpoint)
    return staged(state.select(F.col("key.digest").alias("digest"), F.col("value").getField("max").alias("holder"),
                               F.col("value").getField("count").alias("size")), "state")


def deduplicate(docs: DataFrame, folder: str | None = None, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id (identifier of the row that stays), group_size, kept,
    text_sha256, and the row's place (file, row). ``folder`` keeps arrivals and state between runs
    (default: a new one)."""
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "exact")
    rows = _located(docs).withColumn("digest", digest(F.col("text")))
    keys = rows.select("digest", "doc_id", "file", "row")
    keys.write.mode("append").parquet(f"{folder}/arrivals")
    state = fold(f"{folder}/arrivals", f"{folder}/state", spark)

    hits = state.filter("size > 1").select("digest")
    # beyond the bound all texts are compared: the aggregate does not need the filter
    suspects = rows.join(F.broadcast(hits), "digest", "left_semi") if hits.count() <= BROADCAST_HITS else rows
    texts = staged(suspects.groupBy("digest", "text").agg(_holder().alias("own_holder"),
                                                          F.count(F.lit(1)).alias("own_size")), "texts")
    clashes = texts.groupBy("digest").count().filter("count > 1").select("digest")
    placed = rows.select("digest", "doc_id", "file", "row", sha256(F.col("text")).alias("text_sha256"))
    found = placed.join(state, "digest", "left")
    holder, size = F.col("holder"), F.col("size")
    if clashes.limit(1).count():  # rows of such a digest look for their own text
        apart = (rows.join(texts.join(clashes, "digest", "left_semi"), ["digest", "text"])
                 .select("file", "row", "own_holder", "own_size"))
        found = found.join(apart, ["file", "row"], "left")
        holder, size = F.coalesce("own_holder", "holder"), F.coalesce("own_size", "size")
    return found.select(
        "doc_id", holder["doc_id"].alias("keep_id"), size.cast("long").alias("group_size"),
        holder.eqNullSafe(F.struct("doc_id", "file", "row")).alias("kept"), "text_sha256", "file", "row")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without those that repeat a text: the largest doc_id stays."""
    kept = deduplicate(docs).filter("kept").select(F.col("file").alias("_file"), F.col("row").alias("_row"))
    columns = docs.columns
    here = docs.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    return here.join(kept, ["_file", "_row"], "left_semi").select(*columns)
