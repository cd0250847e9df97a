from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest

import __spark_entry__ as contract
from spendlens.llm import queries

DIR = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DIR).write.parquet(f"file://{tmp_path}/{i}")
        before, docs = docs, spark.read.parquet(f"file://{tmp_path}/{i}")
        kept[name] = docs
        if i < 4:
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    toxic = {r.doc_id for r in spark.read.parquet(f"{DIR}/labels.parquet").filter("toxic = 1").collect()}
    left = {r.doc_id for r in kept["toxicity"].select("doc_id").collect()}
    assert len(toxic & left) < 0.5 * len(toxic) and len(left) > 800  # 45 toxic texts to learn from
    texts = Counter(r.text for r in kept["exact_dedup"].select("text").collect())
    assert max(texts.values()) == 1
    assert kept["near_dedup"].count() < kept["exact_dedup"].count()
    assert kept["substring_dedup"].count() == kept["near_dedup"].count()
    assert {r.doc_id for r in kept["packing"].collect()} == {r.doc_id for r in kept["substring_dedup"].collect()}


def test_registered():
    names = list(contract.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_exact_dedup_against_sql(spark):
    compare = pytest.importorskip("compare")
    name = "op2_streaming_exact_dedup"
    missing, extra, problem = compare.differences(
        compare.connect(DIR), queries.QUERIES[name](spark, DIR), queries.ORACLES[name])
    assert problem is None and not missing and not extra
