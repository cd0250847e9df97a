from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from spendlens.llm import queries, runs
from spendlens.llm.words import words_of

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def brute_force(words):
    """Runs by comparing every word with the one a period ahead, for every period."""
    n, found, taken = len(words), [], set()
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= 4 * q and (start, length) not in taken:
                taken.add((start, length))
                found.append((start, length, q))
            start = end + 1
    return sorted(r for r in found if r[1] >= 6)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = brute_force(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (doc_id, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def of_words(texts):
    import pyarrow as pa

    words = words_of(pa.array([" ".join(t) for t in texts], type=pa.string()))
    document, found = runs.maximal_runs(runs.word_ranks(words), words.first)
    return [[tuple(r) for r in found[document == i].tolist()] for i in range(len(texts))]


def nested(rng, depth, letters):
    """A stretch that is repeated, parts of which were repeated before, with a flaw now and then."""
    if not depth:
        return [rng.choice(letters) for _ in range(rng.randrange(1, 4))]
    text = []
    for _ in range(rng.randrange(1, 3)):
        part = nested(rng, depth - 1, letters)
        text += part * rng.choice([1, 1, 3, 4, 5, 9]) + part[:rng.randrange(len(part) + 1)]
    if text and rng.random() < 0.3:
        text[rng.randrange(len(text))] = rng.choice(letters)
    return text


@pytest.mark.parametrize("seed", range(24))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = [f"w{i}" for i in range(rng.choice([1, 2, 3, 8]))]
    texts = [nested(rng, rng.randrange(4), letters)[:600] for _ in range(30)] + [[]]
    texts += [[rng.choice(letters) for _ in range(rng.randrange(200))] for _ in range(10)]
    assert of_words(texts) == [brute_force(t) for t in texts]


@pytest.mark.parametrize("period", [1, 2, 3, 5, 6, 7, 11, 12, 23, 24, 25, 47, 48, 95, 96, 100])
def test_every_period_at_the_shortest_length(period):
    block = [f"a{i}" for i in range(period)]
    uneven = ["a"] * (period - 1) + ["b"]
    texts = [block * 4, block * 4 + block[:1], (block * 4)[:-1], ["x"] + block * 4 + ["y"], uneven * 4, uneven * 5]
    assert of_words(texts) == [brute_force(t) for t in texts]


def test_words_with_one_name_are_told_apart():
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    assert of_words([[a, b] * 4, [a] * 6, [a, b, b, a] * 4]) == [[(0, 8, 2)], [(0, 6, 1)], [(0, 16, 4)]]


def test_names_that_collide_are_drawn_anew(monkeypatch):
    real, calls = runs.scramble, []

    def weak(x):
        calls.append(1)
        return real(x) if len(calls) > 1 else np.zeros_like(x)

    monkeypatch.setattr(runs, "scramble", weak)
    assert of_words([list("abcdefgh") * 2, list("abcabcabcabcx")]) == [[], [(0, 12, 3)]]
    assert len(calls) == 2


def test_rows_of_every_kind(spark, table):
    rng = random.Random(5)
    texts = [None, "", " \n", "w", "z z z z z z", "a b " * 9, "ä　b ä　b " * 4, "r " * 30000]
    texts += [" ".join(nested(rng, 3, ["p", "q", "r"])) for _ in range(40)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(None, "n n n n n n", None, None, None)] * 2 + [(3, "w", None, None, 0)]
    docs = table(rows, DOCUMENT).selectExpr("*", "1 AS runs", "2 AS n_words", "3 AS collapsed")
    got = runs.report(runs.find_runs(runs.with_planted_runs(docs))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(r[0], r[1]) for r in rows), key=repr)
    assert runs.report(runs.find_runs(docs.limit(0))).collect() == []


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text.split()) <= 1200]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_synchronising_runs"](spark, sf_dir).collect()}
    assert len(got) == len(rows) and len(short) > 150
    assert all(got[r.doc_id] == expected(r.doc_id, r.text) for r in short)
