"""Daily cost exports: CSV, month to date, so files of one month overlap."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import at_hand
from ..functions.staging import staged

# The columns of an export and their types. The header repeats many names.
EXPORT_COLUMNS = {
    "Date": "date", "BillingAccountId": "string", "BillingAccountName": "string",
    "BillingPeriodStartDate": "date", "BillingPeriodEndDate": "date", "AccountOwnerId": "string",
    "AccountName": "string", "SubscriptionId": "string", "SubscriptionName": "string",
    "Product": "string", "PartNumber": "string", "MeterId": "string", "Quantity": "decimal(18,6)",
    "EffectivePrice": "decimal(18,6)", "CostInBillingCurrency": "decimal(18,2)",
    "CostInPricingCurrency": "decimal(18,2)", "BillingCurrency": "string", "PricingCurrency": "string",
    "ChargeType": "string", "Frequency": "string", "InvoiceSection": "string", "CostCenter": "string",
    "UnitOfMeasure": "string", "Location": "string", "MeterName": "string", "MeterCategory": "string",
    "MeterSubCategory": "string", "MeterRegion": "string", "SubscriptionGuid": "string",
    "OfferId": "string", "IsAzureCreditEligible": "boolean", "ServiceName": "string",
    "ServiceTier": "string", "ServiceFamily": "string", "UnitPrice": "decimal(18,6)",
    "CostInUSD": "decimal(18,2)", "ExchangeRate": "decimal(18,6)", "ExchangeRateDate": "date",
    "InvoiceId": "string", "PreviousInvoiceId": "string", "PricingModel": "string",
    "ServiceInfo1": "string", "ServiceInfo2": "string", "AdditionalInfo": "string", "Tags": "string",
    "ReservationId": "string", "ReservationName": "string", "PricingQuantity": "decimal(18,6)",
    "AvailabilityZone": "string", "BillingProfileId": "string", "BillingProfileName": "string",
}
# Not delivered by every export, but the cost fact needs them.
OPTIONAL_COLUMNS = {"ResourceId": "string", "ResourceGroup": "string"}


KNOWN = {**EXPORT_COLUMNS, **OPTIONAL_COLUMNS}
_CSV = {"escape": '"'}


def header_positions(names: list[str]) -> dict[str, int]:
    """Known column -> its position in the header; the first occurrence of a name counts."""
    chosen: dict[str, int] = {}
    for position, name in enumerate(names):
        if name in KNOWN:
            chosen.setdefault(name, position)
    return chosen


#: Ends of names of compressed files that Hadoop does not split: one task reads such a file from its first line to its last.
UNSPLIT = (".gz", ".deflate", ".snappy", ".lz4", ".zst")
#: Rows of a compressed file, so that many tasks read an export.
FILE_ROWS = 1_000_000
# So many export folders, counted by account, subscription and period, go to every task.
FEW_FOLDERS = 100_000


def write_export(rows: DataFrame, folder: str, order: Sequence[str] = ()) -> None:
    """``rows`` as an export: compressed CSV files with a header. Files whose rows are in some
    ``order`` are smaller."""
    (rows.sortWithinPartitions(*order) if order else rows).write.options(header=True, compression="gzip", maxRecordsPerFile=FILE_ROWS).csv(folder)


def _text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines of text files with their file, the start of their split (``block``) and a number
    that grows inside a split. ``odd`` tells that a line has an odd number of quotes."""
    lines = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(paths)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_modification_time").alias("exportTime"),
        F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).alias("odd"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """file, exportTime, header (a number that equal headers share), quoted (a line has odd quotes)."""
    first = F.min_by(F.xxhash64("value"), F.when(F.col("block") == 0, F.col("at")))
    return _text(spark, path).groupBy("file", "exportTime").agg(first.alias("header"), (F.max("odd") > 0).alias("quoted"))


def _layouts(files: DataFrame) -> list[tuple[list[str], list[str], list[str]]]:
    """(header, files without a line of odd quotes, other files) per header that occurs in ``files``
    (see ``_files``). The driver gets two numbers and a flag per file, and one line per header."""
    spark = files.sparkSession
    by_header: dict[int, tuple[list[str], list[str]]] = {}
    for row in files.orderBy("file").collect():
        by_header.setdefault(row["header"], ([], []))[row["quoted"]].append(unquote(row["file"]))
    layouts = []
    for plain, quoted in by_header.values():
        line = spark.read.option("lineSep", "\n").text((plain or quoted)[0]).first()["value"]
        names = next(csv.reader([line.lstrip("\ufeff").rstrip("\r")]), [])
        if names:
            layouts.append((names, plain, quoted))
    return layouts


def _assembler():
    """The function that puts the lines of splits together. Made here, so that workers need not have this package."""

    def assembled(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        fields = ["file", "exportTime", "block", "line", "record", "whole"]
        of, split, inside, seen, begun, opened = None, None, 0, 0, 0, []

        def rows(lines, records, whole):
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [*(pa.repeat(x, n) for x in of), pa.array(lines, pa.int64()), records, pa.array([whole] * n, pa.bool_())], fields)

        def closed(whole):
            kind = opened[0].type
            text = "\n".join(x for lines in opened for x in lines.to_pylist())
            opened.clear()
            return rows([begun], pa.array([text], kind), whole and begun > 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column("file"), batch.column("block").to_numpy()
            other = (blocks[1:] != blocks[:-1]) | pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if (files[a].as_py(), blocks[a]) != split:
                    if opened:
                        yield closed(False)
                    of, split = [batch.column(c)[a] for c in fields[:3]], (files[a].as_py(), blocks[a])
                    inside, seen, begun = batch.column("inside")[a].as_py(), 0, 0
                lines = batch.column("value").slice(a, b - a)
                odd = pc.count_substring(lines, '"').to_numpy() & 1
                starts = np.flatnonzero((inside + np.cumsum(odd) - odd) % 2 == 0)
                inside = int(inside + odd.sum()) % 2
                lead = int(starts[0]) if len(starts) else b - a  # lines of the record that began before
                if lead:
                    opened.append(lines.slice(0, lead))
                    if len(starts) or not inside:
                        yield closed(True)
                if len(starts):
                    ends = np.append(starts[1:], b - a)
                    if inside:
                        starts, ends, last = starts[:-1], ends[:-1], int(starts[-1])
                        opened.append(lines.slice(last))
                        begun = seen + last + 1
                    if len(starts):
                        records = lines.slice(lead, int(ends[-1]) - lead)
                        if len(records) > len(starts):
                            records = pc.binary_join(pa.ListArray.from_arrays(
                                pa.array(np.append(starts, ends[-1]) - lead, pa.int32()), records), "\n")
                        yield rows(starts + (seen + 1), records, True)
                seen += b - a
        if opened:
            yield closed(False)

    return assembled


def csv_records(lines: DataFrame, split: bool = True) -> DataFrame:
    """The records of CSV files out of their lines (see ``_text``): file, exportTime, block and line where
    a record starts, record. A quoted field may hold line feeds; a quote inside it is doubled.

    A line starts a record if the quotes before it are even in number. Every split counts its own; the
    sum over the splits before it, one small row each, tells whether it begins inside a field. So any
    number of tasks reads one file. A task puts the records of its splits together as it reads them;
    only the two ends of a record that lies across splits are gathered. Without ``split`` every
    file is read by one task, and nothing is counted or gathered.
    """
    kinds = "file string, exportTime timestamp, block long, line long, record string, whole boolean"
    record = ["file", "exportTime", "block", "line", "record"]
    read = ["file", "exportTime", "block", "value"]
    if not split:
        return lines.select(*read, F.lit(0).alias("inside")).mapInArrow(_assembler(), kinds).select(*record)
    splits = lines.groupBy("file", "block").agg(F.sum("odd").alias("odds"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = splits.select("file", "block", (F.sum("odds").over(earlier) % 2).cast("int").alias("inside")).filter("inside = 1")
    placed = lines.select(*read).join(F.broadcast(inside), ["file", "block"], "left").select(*read, F.coalesce("inside", F.lit(0)).alias("inside"))
    pieces = placed.mapInArrow(_assembler(), kinds)
    # the lead of a split, line 0, belongs to the last record that started before and did not end there
    so_far = Window.partitionBy("file").orderBy("block", "line").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.last(F.when(F.col("line") > 0, F.struct("block", "line")), True).over(so_far)
    parts = pieces.filter("NOT whole").withColumn("begins", begins)
    joined = parts.groupBy("file", "exportTime", "begins").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "record"))).alias("lines"))
    joined = joined.select("file", "exportTime", "begins.block", "begins.line", F.array_join("lines.record", "\n").alias("record"))
    return pieces.filter("whole").select(*record).unionByName(joined)


def _typed(lines: DataFrame, names: list[str], raw: bool) -> DataFrame:
    """Declared columns out of ``c0``, ``c1``, ... and the file; as text if ``raw``."""
    chosen = header_positions(names)
    columns = []
    for name, kind in KNOWN.items():
        if name not in chosen:
            columns.append(F.lit(None).cast("string" if raw else kind).alias(name))
            continue
        text = F.col(f"c{chosen[name]}")
        columns.append((text if raw or kind == "string" else text.try_cast(kind)).alias(name))
    folder = F.left("file", F.length("file") - F.length(F.substring_index("file", "/", -1)) - 1)
    return lines.select(*columns, folder.alias("exportFolder"), "exportTime")


def read_export(spark: SparkSession, path: str, raw: bool = False, files: DataFrame | None = None) -> DataFrame:
    """Typed export rows with ``exportFolder`` and ``exportTime`` of their file. Files are read by
    header: their columns may differ in order and number. Columns a header lacks are NULL,
    unreadable numbers and dates too. A quoted field may hold line feeds: files in which that may be
    so are put together by :func:`csv_records`, all others are plain CSV. ``raw`` leaves all values text. ``files``: what is known of them (see ``_files``)."""
    tables = []
    for names, plain, quoted in _layouts(_files(spark, path) if files is None else files):
        fields = ", ".join(f"c{i} string" for i in range(len(names)))
        if plain:
            tables.append(_typed(
                spark.read.options(header=True, **_CSV).schema(fields).csv(plain).select(
                    "*", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_modification_time").alias("exportTime")), names, raw))
        single = [f for f in quoted if f.endswith(UNSPLIT)]
        for split, paths in ((False, single), (True, [f for f in quoted if not f.endswith(UNSPLIT)])):
            if not paths:
                continue
            # the header is the first record of its file; an empty line is no record
            text = F.when(F.contains("record", F.lit("\r")), F.regexp_replace("record", "\r$", "")).otherwise(F.col("record"))
            rows = csv_records(_text(spark, paths), split).filter("NOT (block = 0 AND line = 1) AND trim(record) NOT IN ('', '\r')")
            rows = rows.select("file", "exportTime", F.from_csv(text, fields, {**_CSV, "multiLine": "true"}).alias("row"))
            tables.append(_typed(rows.select("row.*", "file", "exportTime"), names, raw))
    if not tables:
        fields = ", ".join(f"`{n}` {k}" for n, k in KNOWN.items())
        return spark.createDataFrame([], f"{fields}, exportFolder string, exportTime timestamp")
    return reduce(DataFrame.unionByName, tables)


def _headers(files: DataFrame) -> DataFrame:
    """(header number, position, name)"""
    spark = files.sparkSession
    numbers = {row["header"]: row["file"] for row in files.groupBy("header").agg(F.min("file").alias("file")).collect()}
    names = []
    for number, file in numbers.items():  # one line per header that occurs
        line = spark.read.option("lineSep", "\n").text(unquote(file)).first()["value"]
        names += [(number, i, name) for i, name in enumerate(next(csv.reader([line.rstrip("\r")]), []))]
    return spark.createDataFrame(names, "header long, position int, name string")


def layout_drift(spark: SparkSession, path: str, required: Sequence[str] = tuple(EXPORT_COLUMNS)) -> DataFrame:
    """exportFolder, column, problem, rows: how the layout of each export differs.

    ``missing`` (a required column), ``unexpected`` (not a declared one), ``repeated``, ``retyped``
    (with the number of values that the declared type cannot hold), and against the export before
    in the same parent folder, by time and name, ``appeared`` and ``disappeared``. The driver sees one line per header; files
    and values are compared by Spark.
    """
    files = staged(_files(spark, path), "files")
    names = _headers(files)
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    exports = files.groupBy(folder.alias("exportFolder")).agg(F.max("exportTime").alias("exportTime"))
    held = (
        files.select(folder.alias("exportFolder"), "header").distinct().join(names, "header")
        .groupBy("exportFolder", "header", "name").agg(F.count(F.lit(1)).alias("times"))
        .groupBy("exportFolder", F.col("name").alias("column")).agg(F.max("times").alias("times"))
    )

    def report(rows: DataFrame, problem: str, number: Column = F.lit(None)) -> DataFrame:
        return rows.select("exportFolder", "column", F.lit(problem).alias("problem"), number.cast("long").alias("rows"))

    wanted = exports.select("exportFolder", F.explode(F.array(*[F.lit(c) for c in required])).alias("column"))
    pair = ["exportFolder", "column"]
    series = F.regexp_extract("exportFolder", "^(.*)/[^/]*$", 1)  # exports of one folder follow each other
    in_time = Window.partitionBy(series).orderBy("exportTime", "exportFolder")
    before = exports.select("exportFolder", F.lag("exportFolder").over(in_time).alias("previous")).dropna()
    earlier = before.join(held.select(F.col("exportFolder").alias("previous"), "column"), "previous").select(*pair)
    later = held.join(before, "exportFolder", "left_semi").select(*pair)
    kinds = {c: k for c, k in KNOWN.items() if k != "string"}
    rows = read_export(spark, path, raw=True, files=files)
    bad = rows.groupBy("exportFolder").agg(*[
        F.count_if((F.coalesce(F.col(c), F.lit("")) != "") & F.col(c).try_cast(k).isNull()).alias(c) for c, k in kinds.items()])
    retyped = bad.unpivot("exportFolder", list(kinds), "column", "rows").filter("rows > 0")
    return reduce(DataFrame.unionByName, [
        report(wanted.join(held, pair, "left_anti"), "missing"),
        report(held.filter(~F.col("column").isin(list(KNOWN))), "unexpected"),
        report(held.filter("times > 1"), "repeated", F.col("times")),
        report(retyped, "retyped", F.col("rows")),
        report(later.join(earlier, pair, "left_anti"), "appeared"),
        report(earlier.join(later, pair, "left_anti"), "disappeared"),
    ])


# What an export holds as a whole: a later one replaces it.
EXPORT_KEYS = ["BillingAccountId", "SubscriptionId", "BillingPeriodStartDate"]


def latest_export(rows: DataFrame) -> DataFrame:
    """For every billing account, subscription and billing period only the rows of the newest export
    folder. A later month-to-date export holds the whole month again, so it replaces the earlier
    ones; exports of other accounts or subscriptions stay beside it."""
    newest = (
        rows.groupBy(*EXPORT_KEYS, "exportFolder").agg(F.max("exportTime").alias("exportTime"))
        .groupBy(*EXPORT_KEYS).agg(F.max_by("exportFolder", F.struct("exportTime", "exportFolder")).alias("exportFolder"))
    )
    newest = at_hand(staged(newest, "newest").toDF(*[f"_{c}" for c in newest.columns]), FEW_FOLDERS)
    same = [rows[c].eqNullSafe(newest[f"_{c}"]) for c in [*EXPORT_KEYS, "exportFolder"]]
    return rows.join(newest, reduce(Column.__and__, same), "left_semi")
