from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest

from spendlens.llm import minhash, shipping, substrings, words


def texts(size):
    rng = random.Random(8)
    some = [f"{rng.randrange(10**6):x}" for _ in range(20000)]
    rows, total = [], 0
    while total < size:
        rows.append(" ".join(rng.choices(some, k=400)))
        total += len(rows[-1])
    return rows


def part(of, column):
    return pa.RecordBatch.from_arrays([pa.array(range(len(of)), pa.int64()), pa.array(of)], [column, "text"])


@pytest.mark.parametrize("column, step", [("place", substrings._file_windows(35)), ("doc_id", minhash._sketch)])
def test_a_task_works_on_little_at_a_time(column, step):
    batch = part(texts(4 << 20), column)
    list(step(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    try:
        for _ in step(iter([batch])):
            pass
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("step, rest", [(substrings._file_windows, ()), (substrings._name_windows, ()),
                                        (substrings._remove, (True,)), (substrings._rewrite, ())])
def test_workers_give_memory_back(monkeypatch, step, rest):
    calls = []
    monkeypatch.setattr(substrings, "release", lambda: calls.append(1), raising=False)
    list(step(35, *rest)(iter([])))
    assert calls == [1]


def test_names_of_words_far_from_the_start():
    here = texts(100_000)
    together = words.words_of(pa.array([" ".join(here)]))
    apart = words.words_of(pa.array(here))
    assert together.names.tolist() == apart.names.tolist()
    alone = [int(words.words_of(pa.array([t.split()[0]])).names[0]) for t in here]
    assert apart.names[apart.first[:-1]].tolist() == alone
    long = words.words_of(pa.array(["x" * 100_000, "y " + "x" * 100_000])).names
    assert long[0] == long[2] != long[1]


def test_batches_are_bounded(spark, table):
    docs = table([(i, t) for i, t in enumerate(texts(20 << 20))], "doc_id long, text string", files=1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"])

    with shipping.small_batches(spark):
        found = [r.size for r in docs.mapInArrow(sizes, "size long").collect()]
    assert max(found) < 2 * shipping.BATCH_BYTES and sum(found) > 20 << 20
    assert spark.conf.get(shipping.BATCH, None) is None
