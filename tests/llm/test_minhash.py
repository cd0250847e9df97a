from __future__ import annotations

import random
from collections import defaultdict

import pytest

from spendlens.llm import minhash


def brute_force(rows):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[a:a + 5]) for a in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def edited(rng, words, share):
    return [rng.choice(("p", "q", "r")) + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 8, 40, 150, 600]))]
        rows += [edited(rng, base, rng.choice([0, 0.002, 0.01, 0.03, 0.1])) for _ in range(rng.choice([1, 3, 25]))]
        chain = base
        for _ in range(4):  # each step is near the one before, the ends are not near each other
            chain = edited(rng, chain, 0.012)
            rows.append(chain)
    rows = [" ".join(r) for r in rows]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [512, 3])
def test_against_brute_force(table, monkeypatch, seed, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus(seed) + [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\ttwo"), (6, "É a b c"), (7, "é a b c")]
    found = minhash.near_duplicates(table(rows, "doc_id long, text string", files=3)).collect()
    assert sorted(tuple(r) for r in found) == brute_force(rows)


def test_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in minhash.near_duplicates(docs).collect()) == brute_force(rows)


def test_nulls_repeats_and_empty(table):
    docs = table([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "other")],
                 "doc_id long, text string").selectExpr("doc_id", "text", "1 AS bands", "2 AS component")
    rows = sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert rows == [(1, 2, 1, True), (1, 2, 1, True), (2, 1, 2, True), (None, 2, None, True)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
    assert minhash.keep_one(docs).columns == ["doc_id", "text", "bands", "component"]


def test_confirming_batches_are_cut_by_both_texts():
    import pyarrow as pa

    sizes = [(10, 900), (10, 900), (5000, 1), (1, 5000), (0, 0), (300, 300), (300, 300), (300, 300)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(sizes))), pa.array(["x" * a for a, _ in sizes]), pa.array(["y" * b for _, b in sizes])], ["a", "text_a", "text_b"])
    parts = list(minhash._pair_slices(batch, 1900))
    assert [i for part in parts for i in part.column("a").to_pylist()] == list(range(len(sizes)))
    total = lambda part: sum(len(x) for c in ("text_a", "text_b") for x in part.column(c).to_pylist())
    assert all(part.num_rows == 1 or total(part) <= 1900 for part in parts) and len(parts) < len(sizes)
    assert list(minhash._pair_slices(batch.slice(0, 0))) == []


def block(texts, component=None, bucket_band=0):
    """One block as ``_compare_blocks`` gets it, all documents in one bucket of the first band."""
    import numpy as np
    import pyarrow as pa

    column = pa.array(texts)
    owner, value = minhash.shingle_sets(minhash.words_of(column, lower=True))
    sizes = np.bincount(owner, minlength=len(texts))
    minima = minhash.signatures(owner, value, len(texts))
    keys = minhash.band_keys(minima).view(np.int64).copy()
    keys[:, 0] = 7
    return pa.table({
        "band": [bucket_band] * len(texts), "side": [0] * len(texts), "doc": list(range(len(texts))),
        "component": component or list(range(len(texts))), "bands": [k.tolist() for k in keys],
        "bins": [r.tobytes() for r in (minima & np.uint64(255)).astype(np.uint8)],
        "shingles": [x.tobytes() for x in np.split(value, np.cumsum(sizes)[:-1])], "n_shingles": sizes})


def test_a_block_of_near_copies_gives_fewer_links_than_members():
    """All pairs agree on enough bins: one group of linked texts, one of texts just below the limit."""
    base = [f"w{i}" for i in range(400)]
    linked = [" ".join(base[:20 + i] + [f"x{i}"] + base[21 + i:]) for i in range(60)]
    assert minhash._compare_blocks(block(linked)).num_rows == 59
    below = [" ".join([f"y{i}-{j}" if j % 50 == 3 + i % 7 else w for j, w in enumerate(base)]) for i in range(60)]
    rows = list(enumerate(below))
    assert sum(kept for *_, kept in brute_force(rows)) == 60
    assert minhash._compare_blocks(block(below)).num_rows == 0


def test_the_largest_component_meets_only_the_others(table, monkeypatch):
    """Blocks of one bucket hold each pair across components, whichever is the largest one."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 900)
    base = [f"w{i}" for i in range(300)]
    step = lambda n: " ".join([f"z{j}" if j < n * 5 else w for j, w in enumerate(base)])
    rows = [(i * 7 % 23, step(i)) for i in range(23)]
    found = minhash.near_duplicates(table(rows, "doc_id long, text string", files=3)).collect()
    assert sorted(tuple(r) for r in found) == brute_force(rows)
