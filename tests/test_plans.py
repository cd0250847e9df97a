"""Properties of the physical plans that must hold at any data size."""

from __future__ import annotations

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# These write tables while they are built; their parts are covered by the other queries.
WRITING = {"cost_export", "stream_budget_alerts", "stream_daily_metrics", "stream_crossings",
           "incremental_detection", "load_exports_fact"}
LAZY = sorted(set(contract.queries()) - WRITING)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def unpartitioned_windows(text: str) -> list[str]:
    """Window nodes that print an order but no partition: ``[functions], [order]``."""
    nodes = re.findall(r"Arguments: (\[.*windowspecdefinition\(.*\])", text)
    return [n for n in nodes if len(n.split("], [")) == 2 and re.search(r" (ASC|DESC) ", n.split("], [")[1])]


def test_an_unpartitioned_window_is_noticed(spark):
    numbers = spark.range(3)
    assert unpartitioned_windows(plan(numbers.select(F.row_number().over(Window.orderBy("id")))))
    assert not unpartitioned_windows(plan(numbers.select(F.row_number().over(Window.partitionBy("id").orderBy("id")))))
    assert not unpartitioned_windows(plan(numbers.select(F.max("id").over(Window.partitionBy("id")))))


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_no_python_no_global_window(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in text, operator
    # numbering new members orders the sizes of at most 1,024 hash buckets; joining neighbouring ranges
    # orders at most four rows per range, of which there are as many as shuffle partitions
    assert [w for w in unpartitioned_windows(text) if "_bucket" not in w and ", [range#" not in w] == []


@pytest.mark.parametrize("name", ["executive_kpis", "mom_growth", "service_cost_breakdown", "detect_cost_anomalies", "cost_data"])
def test_date_bounds_reach_the_scan(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", text)


@pytest.mark.parametrize("name, columns", [
    ("mom_growth", {"l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"}),
    ("cost_distribution", {"l_suppkey", "l_extendedprice", "l_discount"}),  # the whole history: no day needed
    ("completeness", {"l_shipdate"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    text = plan(contract.queries()[name](spark, SF_DIR))
    read = [set(re.findall(r"(l_\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*)>", text)]
    assert {frozenset(r) for r in read if r} == {frozenset(columns)}


def test_raw_rows_meet_hash_aggregates_only(spark):
    """Sort-based aggregation of raw rows would sort the whole fact."""
    text = plan(contract.queries()["aggregate_daily_metrics"](spark, SF_DIR))
    assert "SortAggregate" not in text
    text = plan(contract.queries()["detect_anomalies"](spark, SF_DIR))
    tree = text[: text.index("\n(1) ")]
    assert tree.rindex("HashAggregate") > tree.rindex("SortAggregate")
