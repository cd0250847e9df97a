from __future__ import annotations

import hashlib

from spendlens.llm import syncmers

ROWS = [(5, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4), (1, None), (2, ""), (9, "é🙂" * 9), (3, "one two"),
        (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 4), (11, "w" * 100_001), (12, " \n ")]


def edited(rows):
    ordered = sorted(rows)
    following = {a[0]: b[1] or "" for a, b in zip(ordered, ordered[1:] + ordered[:1])}
    result = {}
    for i, text in rows:
        text, q = text or "", len(text or "") // 4
        result[i] = (len(text), hashlib.sha256((text[:len(text) - q] + following[i][:q]).encode()).hexdigest())
    return result


def test_edited_texts_and_fingerprints(table):
    rows = syncmers.fingerprint_with_edits(table(ROWS, "doc_id long, text string", files=3)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == edited(ROWS)
    found = {r.doc_id: r for r in rows}
    assert found[5].fingerprint == found[7].fingerprint and found[1].fingerprint == found[12].fingerprint == ""
    assert found[1].near_next == 1.0 and found[5].near_next == 1.0 and found[3].near_next == 0.0


def test_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = syncmers.fingerprint_with_edits(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == edited(texts)
    long = [r for r in rows if r.n_chars > 400]
    assert sum(r.near_edited for r in long) / len(long) > 0.5 and sum(r.near_next < 0.1 for r in long) > 0.9 * len(long)
    assert all(0 <= v <= 1 for r in rows for v in (r.near_edited, r.near_next))


def test_repeated_null_and_empty(table):
    docs = table([(None, "x y z"), (1, "a b c d e f"), (1, "g h"), (2, "k " * 40)], "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 AS id", "2 AS gift")
    assert syncmers.fingerprint_with_edits(docs).count() == 4
    assert syncmers.fingerprint_with_edits(docs.limit(0)).count() == 0


def test_anchors_do_not_depend_on_their_surroundings(spark):
    middle = " ".join(f"w{i * i % 97}" for i in range(60))
    texts = spark.createDataFrame([("x " * 7 + middle,), (middle + " y" * 9,)], "text string").coalesce(1)
    one, two = (dict((k["a"], k["p"]) for k in r.kept) for r in texts.select(syncmers.anchors(texts.text).alias("kept")).collect())
    shared = one.keys() & two.keys()
    assert len(shared) > 15 and {one[a] - two[a] for a in shared} == {7}
