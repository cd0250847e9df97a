from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendlens.llm import toxicity
from spendlens.llm.words import words_of

DIR = "/root/testdata/sf0.1"


def test_gradients_match_differences():
    words = words_of(pa.array(["a bb ccc dd e " * 9, "zz b c"]), lower=True)
    place, _ = toxicity.windows(words.first)
    _, first, back = np.unique(words.names, return_index=True, return_inverse=True)
    index = np.where(place >= 0, back[place], -1)
    vocabulary = toxicity.Vocabulary.of(words, first)
    p = {k: v.astype(np.float64) for k, v in toxicity.parameters(3).items()}
    label, weight = np.arange(len(index)) % 2, np.ones(len(index))

    def loss():
        z = toxicity.logits(p, vocabulary.inputs(p), index)[0]
        return np.sum(np.log1p(np.exp(z)) - label * z)

    g = toxicity.gradients(p, vocabulary, index, label, weight)
    rng = np.random.default_rng(0)
    for name, value in p.items():
        flat, slope = value.reshape(-1), g[name].reshape(-1)
        for i in {int(np.abs(slope).argmax()), int(rng.integers(len(flat)))}:
            kept = flat[i]
            flat[i] = kept + 1e-4
            up = loss()
            flat[i] = kept - 1e-4
            down = loss()
            flat[i] = kept
            assert slope[i] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=2e-3), name


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 56, 57, 500):
        place, text = toxicity.windows(words_of(pa.array(["w " * n, ""])).first)
        assert set(place[place >= 0]) == set(range(n)) and set(text) == {0}


def test_passages_lie_whole_in_a_window():
    place, _ = toxicity.windows(words_of(pa.array(["w " * 300])).first)
    whole = [set(row[row >= 0]) for row in place]
    assert all(any(set(range(a, a + 17)) <= row for row in whole) for a in range(300 - 16))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    toxic, fine = ([r for r in rows if r.toxic == v] for v in (1, 0))
    # 352 toxic texts in four languages to learn from
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic) and sum(r.predicted for r in fine) <= 0.03 * len(fine)


def test_edges(table, spark):
    rows = [(i, "you are an idiot and a fool indeed" if i % 2 else "what a lovely calm day it is", "s") for i in range(40)]
    docs = table(rows + [(90, None, "s"), (91, "", "s"), (92, "x " * 50_000, "s"), (None, "idiot", "s"), (3, "again", "s")],
                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs, model).collect()
    assert len(found) == 45 and all(r.score == 0 for r in found if r.doc_id in (90, 91))
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    for few in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("doc_id = 1")):
        assert toxicity.score(docs, toxicity.learn(docs, few)).count() == 45
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_sample_is_bounded_in_bytes(table, spark, monkeypatch):
    docs = table([(i, ("bad " if i % 2 else "fine ") * (100_000 if i % 3 == 0 else 20)) for i in range(60)], "doc_id long, text string")
    labels, taken = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"), []
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", (450_000, 1_000), raising=False)
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, share: taken.append((texts, toxic)))
    toxicity.learn(docs, labels)
    sizes = [sum(len(t) for t, v in zip(*taken[0]) if v == value) for value in (0, 1)]
    assert 0 < sizes[0] <= 450_000 and 0 < sizes[1] <= 1_000
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", (50, 50), raising=False)
    toxicity.learn(docs, labels)
    assert [len(t) for t in taken[1][0]] == [50, 50]


def test_scores_need_only_the_text(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    once = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    bare = docs.select("doc_id", "text", F.lit("zz").alias("lang"), F.lit("zz").alias("source"))
    assert once == {r.doc_id: r.score for r in toxicity.score(bare, model).collect()}
