from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from spendlens.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    key = lambda t: (t[0], t[1], hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()[:16])
    own = {c: [t[2:] for t in sorted(turns, key=key)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p in members:
        own_saved = (len(members[p]) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += own_saved
    return sorted((
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if built[c] == p))).encode()).hexdigest())
        for p, m in members.items()), key=repr)


def got(conversations, limit, segment=1024):
    turns, members = prefix_trie.with_shared_starts(prefix_trie.ordered_turns(conversations), every=20, most=3)
    return sorted(map(tuple, prefix_trie.prefix_trie(turns, members, limit, segment).select(*COLUMNS).collect()), key=repr)


def dialogues(seed):
    """Conversations out of few turns: many prefixes are shared, many are copies."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 150) + [-5, -20, 4096, 9001, 2**40]:
        size = rng.choice([1, 1, 2, 3, 5, 9, 14])
        first = rng.randrange(100)
        for turn in range(size):
            text = rng.choice(["a b", "c", " d\n e f", ""]) if turn else rng.choice(["hello you", "x"])
            rows.append((c, first + turn if turn else None, rng.choice(["user", "u"]) if rng.random() < 0.3 else "user", text))
    rows += [(c, t, "user", "long run of words") for c in range(1000, 1040) for t in range(6)]
    rows += [(None, 1, "user", "lost"), (7000, 1, None, None), (7000, 1, None, None), (7001, None, None, "z"), (7001, None, None, "z")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, limit", [(1024, 20_000), (1024, 40), (4, 30), (3, 5)])
def test_equals_brute_force(spark, table, segment, limit):
    """Also with heavy prefixes that are cut deeper, and with conversations in several segments."""
    rows = dialogues(segment + limit)
    conversations = table(rows, SCHEMA).selectExpr("*", "1 AS words", "'n' AS node", "2 AS depth")
    assert got(conversations, limit, segment) == brute_force(rows)


def test_empty_table(spark, table):
    assert got(table([], SCHEMA), 20_000) == []


def test_one_conversation_of_many_turns(spark, table):
    rows = [(1, t, "user", f"t {t % 50}") for t in range(300)]
    assert got(table(rows, SCHEMA), 50, segment=32) == brute_force(rows)


@pytest.mark.parametrize("seed", range(10))
def test_double_array_holds_every_path_and_no_other(seed):
    rng = random.Random(seed)
    paths = {tuple(rng.randrange(1 + seed * 5) for _ in range(rng.randrange(1, 9))) for _ in range(300)}
    ordered = sorted(paths, key=len, reverse=True)
    size = np.array([len(p) for p in ordered])
    trie = prefix_trie.DoubleArray(np.concatenate(ordered), np.concatenate([[0], np.cumsum(size)])[:-1], size)
    prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
    cells = {p: trie.find(list(p)) for p in prefixes}
    assert -1 not in cells.values() and len(set(cells.values())) == len(prefixes)
    others = {p + (x,) for p in prefixes for x in range(2 + seed * 5)} - prefixes
    assert all(trie.find(list(p)) == -1 for p in others)


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    result = queries.QUERIES["op12_double_array_trie"](spark, sf_dir)
    assert sorted(map(tuple, result.select(*COLUMNS).collect()), key=repr) == brute_force(map(tuple, rows))
