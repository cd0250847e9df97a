"""CSV exports that many tasks read: records out of lines, across splits."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from spendlens.sources import exports
from spendlens.sources.exports import EXPORT_COLUMNS, read_export


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512b")
    yield
    spark.conf.set(key, before)


def field(rng):
    text = "".join(rng.choice(['a', 'b', ',', '"', '\n', '\n\n', ' ', '\r\n', 'ü', "'"]) for _ in range(rng.choice([0, 1, 3, 9, 40])))
    if any(c in text for c in ',"\n\r') or rng.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text.strip()


@pytest.mark.parametrize("seed", range(6))
def test_records_equal_those_of_the_reader_of_whole_files(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    end = rng.choice(["\n", "\r\n"])
    for number in range(3):
        lines = ["k,x,y"] + [f"{i},{field(rng)},{field(rng)}" for i in range(rng.choice([1, 60, 200]))]
        if rng.random() < 0.5:
            lines.insert(2, "")  # an empty line is no record
        text = end.join(lines) + (end if rng.random() < 0.5 else "")
        (tmp_path / f"part {number}.csv").write_bytes(text.encode())
    whole = spark.read.options(header=True, multiLine=True, escape='"').schema("k string, x string, y string").csv(str(tmp_path))
    lines = exports._text(spark, str(tmp_path))
    assert lines.select("file", "block").distinct().count() > 3
    records = exports.csv_records(lines).filter("NOT (block = 0 AND line = 1) AND trim(record) NOT IN ('', '\\r')")
    got = records.select(F.from_csv(F.regexp_replace("record", "\r$", ""), "k string, x string, y string",
                                    {"escape": '"', "multiLine": "true"}).alias("row")).select("row.*")
    # the other reader turns the line ends of some files into line feeds, also inside fields
    plain = lambda df: sorted((tuple(v and v.replace("\r\n", "\n") for v in r) for r in df.collect()), key=repr)
    assert plain(got) == plain(whole)


def test_one_field_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(2000))
    names = list(EXPORT_COLUMNS)
    row = {"Date": "2024-01-05", "SubscriptionId": "s1", "CostInBillingCurrency": "7", "AdditionalInfo": long}
    after = {"Date": "2024-01-06", "SubscriptionId": "s2", "CostInBillingCurrency": "8"}
    lines = [",".join(names)] + [",".join('"' + r[n].replace('"', '""') + '"' if n in r else "" for n in names) for r in (row, after, after)]
    os.makedirs(tmp_path / "run=1")
    (tmp_path / "run=1" / "part-0.csv").write_text("\n".join(lines))
    rows = read_export(spark, str(tmp_path))
    assert sorted((r.SubscriptionId, int(r.CostInBillingCurrency), r.AdditionalInfo) for r in rows.collect()) == [
        ("s1", 7, long), ("s2", 8, None), ("s2", 8, None)]
    assert exports._text(spark, str(tmp_path)).rdd.getNumPartitions() > 10


def test_files_of_several_headers_with_and_without_line_feeds(spark, tmp_path):
    def write(name, header, *lines):
        os.makedirs(tmp_path / name)
        (tmp_path / name / "p.csv").write_text("\n".join([header, *lines]))

    write("a", "Date,MeterId,Tags", '2024-01-01,m1,"{""a"": ""x""}"', "2024-01-02,m2,")
    write("b", "MeterId,Date,Tags,MeterId", '"m\n3",2024-01-03,,ignored', "m4,nonsense,,ignored")
    write("c", "Date,MeterId,Tags", '2024-01-05,m5,"a\nb"')
    write("d", "")
    rows = read_export(spark, str(tmp_path)).select(F.col("Date").cast("string"), "MeterId", "Tags", F.element_at(F.split("exportFolder", "/"), -1))
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([
        ("2024-01-01", "m1", '{"a": "x"}', "a"), ("2024-01-02", "m2", None, "a"), ("2024-01-03", "m\n3", None, "b"),
        (None, "m4", None, "b"), ("2024-01-05", "m5", "a\nb", "c")], key=repr)


def test_no_files(spark, tmp_path):
    assert read_export(spark, str(tmp_path)).count() == 0


def test_exports_are_read_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exports, "FILE_ROWS", 10)
    rows = spark.range(95).select(
        F.lit("2024-01-05").alias("Date"), F.concat(F.lit("m"), "id").alias("MeterId"), F.lit('a\n"b"').alias("Tags"))
    exports.write_export(rows.coalesce(1), str(tmp_path / "run=1"))
    files = [f for f in os.listdir(tmp_path / "run=1") if f.startswith("part")]
    assert len(files) == 10 and all(f.endswith(".csv.gz") for f in files)
    read = read_export(spark, str(tmp_path))
    assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.MeterId for r in read.collect()) == sorted(f"m{i}" for i in range(95))


@pytest.mark.parametrize("batch", [1, 3, 10000])
def test_records_do_not_depend_on_batches(spark, tmp_path, small_splits, batch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rng = random.Random(batch)
    want = []
    for number, end in enumerate(["", "\n", '"never\nclosed']):  # the last field may lack its quote
        cells = [(f"{number}-{i}", "\n".join("x" * rng.choice([0, 1, 200]) for _ in range(rng.choice([1, 2, 7])))) for i in range(40)]
        want += [f'{k},"{x}"' for k, x in cells] + ["end," + end] * (number == 2)
        (tmp_path / f"{number}.csv").write_text("\n".join(["k,x"] + [f'{k},"{x}"' for k, x in cells]) + ("\nend," if number == 2 else "") + end)
    spark.conf.set(key, str(batch))
    try:
        for split in (True, False):
            if not split:
                spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
            records = exports.csv_records(exports._text(spark, str(tmp_path)), split).filter("NOT (block = 0 AND line = 1)")
            assert sorted(r.record for r in records.collect()) == sorted(want)
    finally:
        spark.conf.set(key, before)
