"""Encoding, counting and packing against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.llm import bpe, packing, token_counts
from spendlens.llm.segments import tokenizer

_rng = random.Random(3)
TEXTS = [None, "", " ", "  a  b ", "a\n b", "x <|endoftext|> y<|endoftext|>", "it's we'll 'S 123 4.5  \n\n", "\x00a \x1c b\x1d",
         "日本語 テスト é́ é", "a ", "🙂🙂 🙂", "'s's 't", "a\x85b \x85 c", "Than, than. THAN!?", "É́x ́y ΑΣ ς İI <|startoftext|>Z",
         "long " * 20_000, "x" * 3_000, "long " * 20_000]
TEXTS += ["".join(_rng.choice(" ab\n\t.'sÉ1🙂 \x00\x1cc\u0301") for _ in range(_rng.randrange(30))) for _ in range(400)]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again")]


@pytest.fixture
def docs(table):
    return table([(i, t, 1, "x") for i, t in ROWS], "doc_id long, text string, ids int, n_tokens string", files=3)


def library(vocabulary):
    encoded = tokenizer(vocabulary).encode_batch([t or "" for _, t in ROWS], add_special_tokens=False)
    return [(i, t or "", e.ids) for (i, t), e in zip(ROWS, encoded)]


def test_round_trip_equals_the_library(docs):
    made, ours = tokenizer("byte_bpe_50k.json"), bpe.round_trip(docs, "byte_bpe_50k.json").collect()
    expected = [(i, len(ids), ",".join(map(str, ids)), made.decode(ids, skip_special_tokens=False))
                for i, _, ids in library("byte_bpe_50k.json")]
    assert sorted((tuple(r) for r in ours), key=repr) == sorted(expected, key=repr)


def test_sample_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    decoded = bpe.round_trip(docs, "byte_bpe_50k.json").select("doc_id", "decoded")
    assert decoded.join(docs, (docs.doc_id == decoded.doc_id) & (docs.text == decoded.decoded)).count() == docs.count()


def test_the_pair_index_looks_up_pairs_beside_merges_only():
    """The first pairs come from a table of byte pairs, all of a part at once."""
    class Counted(dict):
        calls = 0

        def get(self, *key):
            self.calls += 1
            return super().get(*key)

    index, made = bpe.PairIndexBPE(bpe.vocabulary_path("byte_bpe_50k.json")), tokenizer("byte_bpe_50k.json")
    index.ranks = Counted(index.ranks)
    words = [" tokens", "é", "zzzz", "\x00\x01\x02" * 100, " counting", "aaaaaaa", "🙂"]
    found = index.encode([w.encode() for w in words])
    assert found == [made.encode(w, add_special_tokens=False).ids for w in words]
    assert index.ranks.calls <= 2 * sum(len(w.encode()) - len(ids) for w, ids in zip(words, found))
    assert index.encode([]) == []


@pytest.mark.parametrize("entries", [0, 5, 16_384])
def test_counts_equal_the_library(docs, monkeypatch, entries):
    monkeypatch.setattr(token_counts, "TABLE", entries)
    ours = token_counts.token_counts(docs, "byte_bpe_50k.json").collect()
    expected = [(i, len(t.encode()), len(ids)) for i, t, ids in library("byte_bpe_50k.json")]
    assert sorted((tuple(r) for r in ours), key=repr) == sorted(expected, key=repr)


def test_empty_tables(docs):
    none = docs.limit(0)
    assert token_counts.token_counts(none, "byte_bpe_50k.json").count() == 0
    assert bpe.round_trip(none, "byte_bpe_50k.json").count() == packing.pack(none, "word_bpe_49k.json", 2).count() == 0


@pytest.mark.parametrize("limits, share", [(packing.Limits(), None), (packing.Limits(64, 4, 64), None), (packing.Limits(100, 5, 40), "share")])
def test_packing(docs, limits, share):
    docs = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).withColumn(
        "share", F.when(F.col("doc_id") % 3 == 0, 0.5))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    made = tokenizer("word_bpe_49k.json")
    wanted = {i: made.encode(t, add_special_tokens=False).ids + [2] for i, t in texts.items()}
    pieces = packing.pack(docs, "word_bpe_49k.json", 2, limits, share, with_ids=True).collect()
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append(p)
        of_sequence[p.sequence_id].append(p)
        own = wanted[p.doc_id][p.start:p.start + p.length]
        assert p.ids == own and p.doc_tokens == len(wanted[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(own, dtype="<u4").tobytes())
    assert set(of_doc) == set(texts)
    for i, found in of_doc.items():
        at = 0
        for p in sorted(found, key=lambda p: p.start):
            assert p.start == at
            at += p.length
        assert at == len(wanted[i])
    for found in of_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(found) <= limits.segments


def test_packing_leaves_little_room(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    used = packing.pack(docs, "word_bpe_49k.json", 2).groupBy("sequence_id").agg(F.sum("length").alias("used"))
    sizes = [r.used for r in used.collect()]
    assert sum(4096 - s for s in sizes if s & (s - 1)) < 0.002 * sum(sizes)


def test_the_loss_limit_binds():
    packer = packing.Packer(packing.Limits(100, 10, 30), 0)
    for i in range(200):
        packer.add(i, 20 + i % 90, 10 + i % 15)
    packer.finish()
    tokens = defaultdict(int)
    for document, start, size, sequence, offset in packer.placed:
        assert offset == tokens[sequence]
        tokens[sequence] += size
    assert sum(tokens.values()) == sum(20 + i % 90 for i in range(200)) and max(tokens.values()) <= 100


def test_stems_are_told_apart_by_their_bytes():
    """Words with one name, marks, case, strings of special tokens, slices with an offset."""
    import pyarrow as pa

    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    texts = [f"{a} {b} {a}.", "Ab ab, AB!! .,. a.b ,,,, x", None, "", "<|endoftext|> <|ENDOFTEXT|>", "İß ﬁ K é. É! 中文, 9. a9,", f"{b}", f"{a}"]
    column, made = pa.array(texts), tokenizer("word_bpe_49k.json")
    words = packing._Words("word_bpe_49k.json")
    for part in (column, column.slice(3), column):
        flat, first = words.encode(part)
        found = [flat[first[i]:first[i + 1]].tolist() for i in range(len(part))]
        assert found == [made.encode(t or "", add_special_tokens=False).ids for t in part.to_pylist()]


def test_a_document_is_added_without_a_look_at_those_that_wait():
    packer, looks = packing.Packer(packing.Limits(), 0), []

    class Wait(packing.deque):
        def __iter__(self):
            looks.append(len(self))
            return super().__iter__()

    packer.wait = Wait()
    for i in range(packing.POOL - 1):
        packer.add(i, 1 + i, 0)
    assert not looks and packer.waiting == sum(range(packing.POOL)) and not packer.placed
    packer.finish()
    assert sum(p[2] for p in packer.placed) == sum(range(packing.POOL))


def test_new_words_are_encoded_in_two_calls():
    import pyarrow as pa

    words, made = packing._Words("word_bpe_49k.json"), tokenizer("word_bpe_49k.json")

    class Counted:
        calls = 0

        def __getattr__(self, name):
            self.calls += 1
            return getattr(made, name)

    words.tokenizer = Counted()
    text = " ".join([f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(2000)] + ["a9", "中文"])
    flat, _ = words.encode(pa.array([text]))
    assert words.tokenizer.calls <= 2
    assert flat.tolist() == made.encode(text, add_special_tokens=False).ids


def test_stems_are_encoded_once_whatever_signs_and_capitals_they_bear():
    import pyarrow as pa

    words, made = packing._Words("word_bpe_49k.json"), tokenizer("word_bpe_49k.json")
    words.encode(pa.array(["therou ouéé écoute , $$$ %%% ). ;;"]))
    words.tokenizer = words.plain = None  # is not asked again
    texts = ["Therou$$$ THEROU%%% therou). Ouéé, Écoute;; ÉCOUTE$$$ therou, $$$ OUÉÉ%%%"]
    flat, _ = words.encode(pa.array(texts))
    assert flat.tolist() == made.encode(texts[0], add_special_tokens=False).ids


def test_a_new_word_does_not_copy_the_known_ones():
    import tracemalloc

    import pyarrow as pa

    words = packing._Words("word_bpe_49k.json")
    words.encode(pa.array([" ".join(map("{:05x}".format, range(100_000)))]))
    words.encode(pa.array(["heard"]))  # after this there is room
    tracemalloc.start()
    words.encode(pa.array(["unheard"]))
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 400_000


@pytest.mark.parametrize("limit", [40, 1_200_000])
def test_words_equal_the_library(monkeypatch, limit):
    """Signs, capitals, characters that compose with their neighbours, long words; the cache begun anew."""
    import pyarrow as pa

    rng = random.Random(5)
    signs = list("  \n\u0085aAbJjKkİßÉéÀÿ×÷µº12.,;:!?'\"$-_`~|<>\\\x00ΣςﬁK日🙂̸́̌̇가 ") + [
        "<|endoftext|>", "<|ENDOFTEXT|>", "'S", "'re", "J̌", "abcdefgh", "ijklmnop"]
    words, made = packing._Words("word_bpe_49k.json"), tokenizer("word_bpe_49k.json")
    monkeypatch.setattr(words, "LIMIT", limit)
    for _ in range(40):
        own = rng.sample(signs, rng.choice([5, 15, len(signs)])) + [" "]
        texts = ["".join(rng.choice(own) for _ in range(rng.randrange(60))) for _ in range(50)]
        flat, first = words.encode(pa.array(texts))
        found = [flat[first[i]:first[i + 1]].tolist() for i in range(len(texts))]
        assert found == [made.encode(t, add_special_tokens=False).ids for t in texts]
