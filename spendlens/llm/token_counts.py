"""Token counts by a two-tier lookup on the map side.

Tier one is a table of the corpus's most frequent pre-token segments and their numbers of tokens,
at most ``TABLE`` entries of at most ``LONGEST`` characters, broadcast to every worker. Each task
counts its own segments in bounded memory and hands on one summary of at most ``TABLE`` entries;
summaries are merged in ``GROUPS`` groups and then on the driver, whose input is bounded by both.
Pre-tokens themselves are never shuffled. Tier two is each worker's cache: segments that the table
lacks are encoded by the tokenizer once per worker and kept up to a bound. The table decides only
who answers, never the answer. Null counts as empty; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segments import SegmentCache, tokenizer
from .shipping import ship
from .words import buffers, slices

TABLE = 16_384
LONGEST = 32
GROUPS = 32
#: Entries of a task's counter; beyond it the rarer half is let go, which costs at most accuracy.
COUNTER = 200_000

_SUMMARY = pa.schema([("part", pa.int32()), ("segments", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _top(counts: Counter) -> pa.RecordBatch:
    best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:TABLE]
    context = TaskContext.get()
    return pa.RecordBatch.from_arrays(
        [pa.array([context.partitionId() % GROUPS if context else 0], pa.int32()),
         pa.array([[s for s, _ in best]], pa.list_(pa.string())),
         pa.array([[n for _, n in best]], pa.list_(pa.int64()))], schema=_SUMMARY)


def _summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for part in slices(batch, "text"):
            for text in part.column("text").to_pylist():
                counts.update((text or "").replace("\0", " ").replace(" ", "\0 ").split("\0"))
            if len(counts) > COUNTER:
                counts = Counter(dict(counts.most_common(COUNTER // 2)))
    yield _top(Counter({s: n for s, n in counts.items() if len(s) <= LONGEST and not SegmentCache._uncuttable(s)}))


def _merge(group: pa.Table) -> pa.Table:
    counts: Counter = Counter()
    for segments, numbers in zip(group.column("segments").to_pylist(), group.column("counts").to_pylist()):
        for segment, number in zip(segments, numbers):
            counts[segment] += number
    return pa.Table.from_batches([_top(counts)])


def frequent_segments(docs: DataFrame) -> list[str]:
    """The most frequent segments of all documents, at most ``TABLE``."""
    ship(docs.sparkSession)
    kind = "part int, segments array<string>, counts array<bigint>"
    merged = docs.select(F.col("text").cast("string")).mapInArrow(_summarize, kind).groupBy("part").applyInArrow(_merge, kind)
    total: Counter = Counter()
    for row in merged.toLocalIterator():
        for segment, number in zip(row["segments"], row["counts"]):
            total[segment] += number
    return [s for s, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:TABLE]]


class _Counter:
    def __init__(self, vocabulary: str, known: dict[str, int]):
        self.tokenizer = tokenizer(vocabulary)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = SegmentCache(self.encode, special, known=known)

    def encode(self, segments: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)]


_counters: dict[tuple[str, int], _Counter] = {}

_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _count(vocabulary: str, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (vocabulary, table.id if hasattr(table, "id") else hash(tuple(table.value)))
        if key not in _counters:
            _counters.clear()
            _counters[key] = _Counter(vocabulary, table.value)
        counter = _counters[key]
        for batch in batches:
            for part in slices(batch, "text"):
                tokens = [sum(v) for v in counter.cache.values([t or "" for t in part.column("text").to_pylist()])]
                sizes = np.diff(buffers(part.column("text"))[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                    schema=_COUNTS)

    return run


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: doc_id, n_bytes of its text in UTF-8, n_tokens."""
    segments = frequent_segments(docs)
    table = dict(zip(segments, _Counter(vocabulary, {}).encode(segments)))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _count(vocabulary, shared), "doc_id long, n_bytes long, n_tokens long")
