"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.staging import staged
from . import (
    bpe, exact_dedup, html_text, language, minhash, packing, prefix_trie, runs, substrings, syncmers, token_counts, toxicity, warc,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(_pages(spark, sf_dir)).drop("url")


def op2_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(_documents(spark, sf_dir)).drop("file", "row")


def op3_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(_documents(spark, sf_dir), digests=True)
    return kept.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), "word_bpe_49k.json", closing=2)


def op5_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op6_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(_documents(spark, sf_dir), "byte_bpe_50k.json", digests=True)
    return coded.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(_documents(spark, sf_dir), "byte_bpe_50k.json")
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op8_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_with_edits(_documents(spark, sf_dir))


def op9_nearest_url_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_pages(spark, sf_dir))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op11_piece_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = language.with_held_out(_documents(spark, sf_dir))
    return language.predict(docs, language.learn(docs.filter("NOT held_out")))


def op12_double_array_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = staged(prefix_trie.ordered_turns(conversations), "turns")
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_starts(turns, every=20, most=3)).drop("node", "parent")


def op13_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.report(runs.find_runs(runs.with_planted_runs(_documents(spark, sf_dir))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_capture_index": op1_warc_capture_index,
    "op2_streaming_exact_dedup": op2_streaming_exact_dedup,
    "op3_recompression_dedup": op3_recompression_dedup,
    "op4_vector_packing": op4_vector_packing,
    "op5_toxicity_gru": op5_toxicity_gru,
    "op6_pair_index_bpe": op6_pair_index_bpe,
    "op7_token_counts": op7_token_counts,
    "op8_closed_syncmers": op8_closed_syncmers,
    "op9_nearest_url_text": op9_nearest_url_text,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_piece_unigrams": op11_piece_unigrams,
    "op12_double_array_trie": op12_double_array_trie,
    "op13_synchronising_runs": op13_synchronising_runs,
}

ORACLES: dict[str, str] = {
    "op2_streaming_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    # h is the CRC-32 of the decimal conv_id, bit by bit; a node is named by the MD5 of its turns
    "op12_double_array_trie": """
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS seq FROM turns GROUP BY conv_id),
        hashed AS (
            SELECT conv_id, seq, xor(4294967295, list_reduce(
                       list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                       lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                                lambda d, z: xor(d >> 1, 3988292384 * (d & 1))))) % 4 AS h
            FROM own),
        built AS (
            SELECT c.conv_id, list_concat(coalesce(b.seq[1:c.h], []), c.seq[c.h + 1:]) AS seq
            FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
        prefixes AS (
            SELECT conv_id, d AS depth, md5(seq[1:d]::VARCHAR) AS node, md5(seq[1:d - 1]::VARCHAR) AS parent,
                   d = len(seq) AS ends,
                   CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(seq[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
            FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM built)),
        nodes AS (
            SELECT node, depth, CASE WHEN depth > 0 THEN any_value(parent) END AS parent, min(conv_id) AS conv_id,
                   count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM prefixes GROUP BY node, depth),
        children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
        below AS (
            SELECT DISTINCT a.node AS top, b.node FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
        sums AS (
            SELECT top AS node, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
                   sum((n.n_convs - 1) * n.words)::BIGINT AS saved_tokens
            FROM below JOIN nodes n ON n.node = below.node LEFT JOIN children c ON c.node = below.node GROUP BY top)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
               s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN nodes p ON p.node = n.parent
             LEFT JOIN children c ON c.node = n.node""",
}
