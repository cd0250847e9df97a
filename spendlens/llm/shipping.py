"""What tasks in Python need: this package for workers that were not given it, batches of bounded size."""

from __future__ import annotations

import contextlib
import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from ..functions.staging import work_folder

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Executor and worker each hold whole batches; Spark's own limit is 64 MB.
BATCH_BYTES = 8 << 20
_done: set[str] = set()


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run inside hands batches of about BATCH_BYTES to Python, or what the session asks for."""
    asked = spark.conf.get(BATCH, None)
    if asked is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if asked is None:
            spark.conf.unset(BATCH)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder of the shared store, for the driver and for tasks."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:") if uri.startswith(("/", "file:/")) else uri
    return pafs.FileSystem.from_uri(uri)


def ship(spark: SparkSession) -> None:
    """Once per application: put the package's sources on the path of every worker. The archive
    is code only and lies in the shared folder."""
    context = spark.sparkContext
    if context.applicationId in _done:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    folder = work_folder(spark, "code")
    store, path = open_store(folder)
    store.create_dir(path)
    with store.open_output_stream(f"{path}/{root.name}.zip") as out:
        out.write(packed.getvalue())
    context.addPyFile(f"{folder}/{root.name}.zip")
    _done.add(context.applicationId)
