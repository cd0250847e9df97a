from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from spendlens.llm import substrings


def brute_force(rows, window):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[a:a + window]) for _, w in texts for a in range(len(w) - window + 1))
    out = []
    for i, words in texts:
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            if seen[tuple(words[a:a + window])] > 1:
                gone[a:a + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=repr)


def corpus(seed, letters, documents=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(letters)]
    passages = [[rng.choice(words) for _ in range(rng.choice([9, 30, 34, 35, 36, 50, 90]))] for _ in range(6)]
    rows = []
    for i in range(documents):
        text = []
        for _ in range(rng.randrange(6)):
            text += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randrange(60))]
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(text)))
    return rows


@pytest.mark.parametrize("seed, letters, window", [(1, 3, 35), (2, 400, 35), (3, 2, 12), (4, 1, 35), (5, 30, 20)])
def test_against_brute_force(table, seed, letters, window):
    rows = corpus(seed, letters) + [(100, None), (101, ""), (102, " \n"), (103, "é\x1c a\xa0b"), (None, "w0 " * 50)]
    rows += [rows[3], (3, "other words " * 30), (200, "x y " * 3000)]
    df = substrings.remove_repeats(table(rows, "doc_id long, text string", files=3), window, digests=True)
    assert got(df) == brute_force(rows, window)


@pytest.mark.parametrize("files", [("TE", "T"), ("TE", "TE"), ("TE", "T", "TT"), ("TEF", "E", "FTT"), ("ETF", "T", "T")])
def test_repeats_between_parts(table, files):
    """T is a text, E and F are copies of it with a word changed; each file is a part of its own."""
    rng, parts = random.Random(6), [[] for _ in files]
    for i in range(40):
        text = [f"w{rng.randrange(5000)}" for _ in range(200)]
        copies = {"T": text, "E": text[:90] + ["edit"] + text[91:], "F": text[:120] + ["other"] + text[121:]}
        for part, letters in zip(parts, files):
            part += [(1000 * i + len(part), " ".join(copies[x])) for x in letters]
    docs = [table(rows, "doc_id long, text string", f"parts/n={n}", 1) for n, rows in enumerate(parts)]
    whole = docs[0].sparkSession.read.parquet(docs[0].inputFiles()[0].rsplit("/", 2)[0])
    assert whole.rdd.getNumPartitions() == len(files)
    df = substrings.remove_repeats(whole, digests=True)
    assert got(df) == brute_force([r for rows in parts for r in rows], 35)


def test_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(substrings.remove_repeats(docs, digests=True)) == brute_force(rows, 35)


def test_empty_and_clashing_columns(table):
    docs = table([(1, "a b", "p", 1)], "doc_id long, text string, place string, spans int")
    assert [tuple(r)[1:] for r in substrings.remove_repeats(docs).collect()] == [(1, 2, 0, "a b")]
    assert substrings.remove_repeats(docs.limit(0)).count() == 0
