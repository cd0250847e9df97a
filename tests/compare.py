"""Run registered queries against their SQL answers: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else 0.0 + value
    return value


def normalized(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(con, spark_df, sql: str):
    """(missing in Spark, extra in Spark, problem with the columns or None)"""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = normalized(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return expected, Counter(), f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    actual = normalized(spark_df.columns, spark_df.collect())
    return expected - actual, actual - expected, None


if __name__ == "__main__":
    from conftest import make_session

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, oracle = make_session(), connect(sf_dir), contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name not in oracle:
                print(f"ROWS {name} {df.count()} {time.time() - start:.2f}s", flush=True)
                continue
            missing, extra, problem = differences(con, df, oracle[name])
        except Exception as error:  # report and go on with the next query
            print(f"FAIL {name}: {str(error)[:700]}", flush=True)
            continue
        took = f"{time.time() - start:.2f}s"
        if problem or missing or extra:
            print(f"DIFF {name} {took} {problem} missing={sum(missing.values())} extra={sum(extra.values())}", flush=True)
            print("   ", list(missing)[:2], "\n   ", list(extra)[:2], flush=True)
        else:
            print(f"OK   {name} {took}", flush=True)
