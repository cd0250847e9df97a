"""A third of all rows on one resource, meter, day and user: the answers stay whole."""

from __future__ import annotations

import shutil

import duckdb
import pytest
from compare import TABLES, connect, differences

import __spark_entry__ as contract

SOURCE = "/root/testdata/sf0.001"
HOT = ["detect_anomalies", "anomalous_cost_data", "daily_metrics_summary", "aggregate_daily_metrics", "process_advisor_update",
       "process_advisor_insert", "resource_utilization_sample", "service_cost_breakdown", "measure_cost", "orphan_counts",
       "cost_data_by_range", "executive_kpis"]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for table in set(TABLES) - {"lineitem", "events"}:
        shutil.copy(f"{SOURCE}/{table}.parquet", folder)
    duckdb.sql(f"""COPY (SELECT * REPLACE (
        CASE WHEN l_orderkey % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey, CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey,
        CASE WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '2001-07-20' ELSE l_shipdate END AS l_shipdate)
        FROM '{SOURCE}/lineitem.parquet') TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    duckdb.sql(f"""COPY (SELECT * REPLACE (
        CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-27' ELSE ts END AS ts, CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id,
        CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS event_type)
        FROM '{SOURCE}/events.parquet') TO '{folder}/events.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", HOT)
def test_hot_keys(spark, skewed, name):
    missing, extra, problem = differences(connect(skewed), contract.queries()[name](spark, skewed), contract.oracle_sql()[name])
    assert problem is None and not missing and not extra
