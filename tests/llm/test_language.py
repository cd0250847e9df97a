from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from spendlens.llm import language, queries

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
PIECES = [bytes([b]) for b in range(256)] + sorted({b"ab", b"abc", b"ba", b" a", b" ab", b"bca", b"cab", b"aaaa", b" abcab"})


def segmentations(word):
    """All ways to cut a word into pieces."""
    if not word:
        yield []
    for i, piece in enumerate(PIECES):
        if word.startswith(piece):
            for rest in segmentations(word[len(piece):]):
                yield [i, *rest]


def lattice(words):
    return language._lattice(language.Pieces(PIECES), words)


@pytest.fixture
def chance():
    drawn = np.random.default_rng(1).random((len(PIECES), 3)) + 0.01
    return drawn / drawn.sum(axis=0)


WORDS = [b" abcabc", b" a", b" ", b" aaaaaaaa", b" bcabcab", b" zab", b"\xc3\xa9ab", b" aaaaaaaaa"]


def test_forward_sums_all_segmentations(chance):
    found, order = lattice(WORDS)
    got = np.empty((len(WORDS), 3))
    got[order] = found.log_chances(chance)
    for i, word in enumerate(WORDS):
        total = sum(np.prod(chance[cut], axis=0) for cut in segmentations(word))
        assert np.allclose(got[i], np.log(total))


def test_expected_counts_weigh_all_segmentations(chance):
    found, order = lattice(WORDS)
    times = np.arange(1.0, len(WORDS) + 1)
    got = found.expected(chance[:, :1], times[order])
    expected = np.zeros(len(PIECES))
    for word, n in zip(WORDS, times):
        cuts = list(segmentations(word))
        weight = np.array([np.prod(chance[cut, 0]) for cut in cuts])
        for cut, share in zip(cuts, weight / weight.sum()):
            np.add.at(expected, cut, n * share)
    assert np.allclose(got, expected)


def test_a_very_long_word_neither_over_nor_underflows(chance):
    found, _ = lattice([b" " + b"abc" * 20_000])
    assert np.isfinite(found.log_chances(chance * 1e-9 + 1e-12)).all()


def test_pieces_match_where_they_occur():
    rng = random.Random(3)
    text = bytes(rng.choice(b"abc ") for _ in range(500))
    ends = np.full(len(text), len(text))
    where, length, piece = language.Pieces(PIECES).matches(np.frombuffer(text, dtype=np.uint8).astype(np.int64), ends)
    expected = {(i, len(p), k) for i in range(len(text)) for k, p in enumerate(PIECES) if text.startswith(p, i)}
    assert set(zip(where.tolist(), length.tolist(), piece.tolist())) == expected


def test_rows_of_every_kind(spark, table):
    rng = random.Random(4)
    of = {"xx": ["haba", "bahab", "habab"], "yy": ["kolo", "loko", "okol"]}
    rows = [(i, " ".join(rng.choice(of[lang]) for _ in range(20)), lang, "s", 1) for i, lang in enumerate(["xx", "yy"] * 40)]
    rows += [(1000, None, "xx", None, None), (1001, "", "yy", None, 0), (1002, "12 ## 3", "xx", None, 0),
             (None, "kolo kolo", None, None, None), (1003, "HABA haba", None, None, 9), (1003, "HABA haba", None, None, 9),
             (1004, "loko " * 50_000 + "x" * 30_000, None, None, 1)]
    docs = table(rows, DOCUMENT).selectExpr("*", "1 AS score", "'q' AS lang_pred", "3 AS letters", "4 AS plain")
    model = language.learn(docs)
    got = {(r.doc_id, r.lang_pred) for r in language.predict(docs, model).collect()}
    assert {(1000, "und"), (1001, "und"), (1002, "und"), (None, "yy"), (1003, "xx"), (1004, "yy")} <= got
    assert all((i, lang) in got for i, _, lang, *_ in rows[:80])
    scores = [r.score for r in language.predict(docs, model).collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores)
    empty = language.predict(docs, language.learn(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in empty} == {("und", 0.0)} and len(empty) == len(rows)
    assert language.predict(docs.limit(0), model).collect() == []


def test_a_score_is_the_share_of_the_text_s_probability(spark, table):
    docs = table([(1, "haba bahab", "xx", None, 0), (2, "kolo loko", "yy", None, 0), (3, "haba loko", None, None, 0)], DOCUMENT)
    model = language.learn(docs, rounds=1)
    pieces = language.Pieces(language.pieces_of(model.vocabulary))
    chance = language._load(model.folder, pieces.size)
    assert np.allclose(chance.sum(axis=0), 1)
    found, _ = language._lattice(pieces, [b" haba", b" loko"])
    total = found.log_chances(chance).sum(axis=0)
    row = language.predict(docs.filter("doc_id = 3"), model).first()
    best = int(total.argmax())
    assert row.lang_pred == model.languages[best]
    assert math.isclose(row.score, 1 / np.exp(total - total[best]).sum(), rel_tol=1e-9)


def test_held_out_texts_are_recognised(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op11_piece_unigrams"](spark, sf_dir).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
