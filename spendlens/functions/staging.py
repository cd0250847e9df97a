"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables below the shared folder the session names in
    ``spark.checkpoint.dir``. Only a local session may leave it unset: it works below its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files: Spark removes them when a write or collection
    ends, not when the driver's garbage is collected. A frame must not be collected twice inside."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a work folder and read it back: later steps neither repeat its plan nor read
    files they are about to replace, and a lost executor costs only its own tasks."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
