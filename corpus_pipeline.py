"""The corpus pipeline: five stages over documents, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.functions.staging import staged
from spendlens.llm import exact_dedup, minhash, packing, substrings, toxicity


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels, does not reject."""
    return toxicity.keep_clean(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those with equal texts, the largest id."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the smallest id."""
    return minhash.keep_one(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of windows of 35 words that occur elsewhere too. A text
    that loses no word stays as it is; one that does has the words left, joined by one space."""
    return substrings.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens, with their ids."""
    return packing.pack(docs, "word_bpe_49k.json", closing=2, with_ids=True)


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("near_dedup", near), ("substring_dedup", substring), ("packing", packed)]

#: SQL cannot express the learned score, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
