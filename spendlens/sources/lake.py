"""The tables as Parquet directories: layers, reads with declared schemas, and repeatable writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import conform
from ..functions.staging import staged
from ..operators.rollup import upserted
from ..schema import PARTITION_COLUMN, schema
from ..star import Star

# Lake layers.
LAYERS = {"raw": "raw", "dim": "silver", "fact": "gold", "budget": "silver"}
EXPORTS = "cost-exports"


def read_or_empty(spark: SparkSession, path: str, fields: StructType) -> DataFrame:
    """The table at ``path``; no rows before the first write."""
    try:
        return spark.read.schema(fields).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)


def write_days(df: DataFrame, path: str, day: str, mode: str, compression: str | None = None) -> None:
    """Write by day: ``append`` adds, ``overwrite`` replaces exactly the days present in ``df``. The
    rebalance hint gathers a day in few files and lets adaptive execution split a day that is too
    large for one task; inside a file rows are ordered by resource."""
    order = [day, *[c for c in ("resourceKey",) if c in df.columns]]
    (
        df.hint("rebalance", day).sortWithinPartitions(*order).write.mode(mode)
        .option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path, compression=compression)
    )


def merge_days(
    path: str, fields: StructType, source: DataFrame, keys: Sequence[str], updated: Sequence[str],
    day: str = "dateKey",
) -> int:
    """Upsert ``source`` into the day-partitioned table at ``path``; returns the rows of ``source``.

    Only the days of ``source`` are read and rewritten. The merged days are staged first, so the
    table is never read while it is replaced, and repeating a failed run gives the same result.
    """
    spark = source.sparkSession
    source = staged(source, "incoming")
    first, rows = source.agg(F.min(day), F.count(F.lit(1))).first()
    if not rows:
        return 0
    days = source.select(day).distinct()
    target = read_or_empty(spark, path, fields).filter(F.col(day) >= first).join(days, day, "left_semi")
    merged = staged(upserted(target, source, list(keys), list(updated)), "merged")
    write_days(merged, path, day, "overwrite")
    return rows


class Lake:
    """Tables by name below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{LAYERS[table.split('_')[0]]}/{table}"

    def export_path(self) -> str:
        return f"{self.root}/{EXPORTS}"

    def read(self, table: str) -> DataFrame:
        return read_or_empty(self.spark, self.path(table), schema(table))

    def append(self, table: str, rows: DataFrame) -> int:
        """Add rows. They are staged first: the count is known, and rows that were chosen by reading
        the table itself stay chosen when the write is repeated."""
        return self._write(table, rows, "append")

    def replace(self, table: str, rows: DataFrame, only_after: int | None = None, ready: bool = False) -> int:
        """A new version of the table (of the days it holds, for a fact). ``rows`` may come from
        the table itself: they are staged before the first file is replaced. With ``only_after``,
        days from that one on which ``rows`` lacks are removed. ``ready``: ``rows`` have been staged,
        are complete, and do not depend on the table any more."""
        return self._write(table, rows, "overwrite", only_after, ready)

    def replace_days(self, table: str, rows: DataFrame) -> None:
        """New versions of the days that ``rows`` hold. They must not depend on the table, and are computed once."""
        write_days(rows, self.path(table), PARTITION_COLUMN[table], "overwrite", "zstd")

    def days(self, table: str) -> list[int]:
        """The days a fact has a folder for: one name per day."""
        folder, files = self._folder(table)
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        prefix = f"{PARTITION_COLUMN[table]}="
        return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))

    def drop_days(self, table: str, days: Sequence[int]) -> None:
        folder, files = self._folder(table)
        for day in days:
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{PARTITION_COLUMN[table]}={day}"), True)

    def _folder(self, table: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _write(self, table: str, rows: DataFrame, mode: str, only_after: int | None = None, ready: bool = False) -> int:
        version = rows if ready else staged(conform(rows, schema(table)), table)
        count = version.count()
        if table in PARTITION_COLUMN:
            day = PARTITION_COLUMN[table]
            if count:
                write_days(version, self.path(table), day, mode)
            if only_after is not None:
                present = {row[0] for row in version.select(day).distinct().collect()}
                self.drop_days(table, [d for d in self.days(table) if d >= only_after and d not in present])
        else:
            version.write.mode(mode).parquet(self.path(table))
        return count

    def upsert(self, table: str, source: DataFrame, keys: Sequence[str], updated: Sequence[str]) -> int:
        return merge_days(self.path(table), schema(table), source, keys, updated, PARTITION_COLUMN[table])


class LakeStar(Star):
    """The star over a lake; tables are read when first asked for."""

    def __init__(self, lake: Lake):
        super().__init__()
        self._lake = lake

    def __getattr__(self, name: str) -> DataFrame:
        if not name.startswith(("dim_", "fact_", "raw_")):
            raise AttributeError(name)
        return self.__dict__["_lake"].read(name)


def landed_json(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A landing folder of JSON lines, typed by the declared schema of ``table``."""
    return spark.read.schema(schema(table)).json(path)
