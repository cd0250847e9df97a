from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from spendlens.llm import exact_dedup

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a "), (7, "b"), (8, "x" * 100_000), (9, "x" * 100_000),
        (7, "b"), (None, "a"), (None, "alone")]


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, best, len(ids), digest) for i in ids]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def test_groups_and_ties(table):
    df = exact_dedup.deduplicate(table(ROWS, "doc_id long, text string"))
    assert got(df) == expected(ROWS)
    assert df.filter("kept").count() == len({t or "" for _, t in ROWS})


def test_colliding_digests_are_told_apart(table):
    docs = table(ROWS, "doc_id long, text string")
    df = exact_dedup.deduplicate(docs, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1).substr(0, 0))
    assert got(df) == expected(ROWS)


def test_clashing_columns_and_empty(table, spark):
    docs = table([(1, "a", "x", 5), (2, "a", "y", 6)], "doc_id long, text string, digest string, kept long")
    assert [tuple(r) for r in exact_dedup.keep_first(docs).collect()] == [(2, "a", "y", 6)]
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_state_carries_over(table, spark, tmp_path):
    folder = f"file://{tmp_path}/kept"
    exact_dedup.deduplicate(table([(1, "a"), (2, "b")], "doc_id long, text string", "one"), folder)
    second = exact_dedup.deduplicate(table([(0, "a"), (5, "c")], "doc_id long, text string", "two"), folder)
    rows = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in second.collect()}
    assert rows == {0: (1, 2, False), 5: (5, 1, True)}
