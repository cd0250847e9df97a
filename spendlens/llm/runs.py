"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least ``EXPONENT`` times as long
as q, that no neighbouring word extends. Runs are found per document, scale by scale; the scale
tau = 1, 2, 4, ... answers for the periods from 1.5 tau up to 3 tau.

1. Every stretch of tau words has a name, a hash of its words. Position i is synchronising if the
   least name among the stretches that begin at i..i+tau begins at i or at i+tau. That depends on the
   2 tau words from i alone, so equal contexts are selected alike, wherever they stand.
2. Stretches with a period of at most tau/4 are left out of that choice: they would be selected
   everywhere. They are the highly periodic regions that smaller scales have found already; period 1
   is found by looking for equal neighbours. What is left has any context at most 12 times within 3 tau.
3. Two synchronising positions with equal contexts at a distance of 1.5 tau up to 3 tau propose their
   distance as a period. In a run of that period one such pair always exists: among its first q
   positions one is synchronising, or all of it would have a smaller period.
4. A proposal is extended to both sides by comparing names of stretches in powers of two. A stretch
   that is also a run of a smaller period keeps that period.
5. All runs are compared word by word. A collision of names can only lengthen a run, never hide a
   proposal; if the words contradict, the names are drawn anew.

Words are told apart by their bytes. Null and empty texts have no words and no run; a text of any
length is taken whole, with memory in proportion to it. Rows are independent: repeated rows and null
identifiers give their own results, an empty table an empty one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .words import U64, Words, buffers, join_names, scramble, slices, words_of

#: A run repeats its period at least this often and has at least this many words.
EXPONENT = 4
SHORTEST = 6
_NONE = U64(1) << U64(63)


def word_ranks(words: Words) -> np.ndarray:
    """A number per word, equal for equal bytes only: the names decide, the bytes are compared."""
    if not len(words.names):
        return np.zeros(0, dtype=np.int64)
    _, first, rank = np.unique(words.names, return_index=True, return_inverse=True)
    twin = first[rank]
    size = words.end - words.start
    if (size == size[twin]).all():
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        own, other = (words.data[np.repeat(words.start[x], size) + inside] for x in (slice(None), twin))
        if (own == other).all():
            return rank
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(words.text(i), len(known)) for i in range(len(size))], dtype=np.int64)


def _ahead(values: np.ndarray, by: int, size: int, fill) -> np.ndarray:
    """``values[i + by]`` for the first ``size`` places, ``fill`` beyond the end."""
    part = values[by:by + size]
    return part if len(part) == size else np.concatenate([part, np.full(size - len(part), fill, dtype=values.dtype)])


class _Texts:
    """Documents one after another, longest first, so that those long enough for a scale come first."""

    def __init__(self, rank: np.ndarray, sizes: np.ndarray, salt: int):
        self.rank, self.sizes = rank, sizes
        self.edge = np.concatenate([[0], np.cumsum(sizes)])
        self.begin = np.repeat(self.edge[:-1], sizes)
        self.end = np.repeat(self.edge[1:], sizes)
        self.names = [scramble(rank.astype(np.uint64) + U64(0x9E37 * salt + 1))]
        while (reach := self.reach(2 << (len(self.names) - 1))):
            last, span = self.names[-1], 1 << (len(self.names) - 1)
            self.names.append(join_names(last[:reach], _ahead(last, span, reach, 0), len(self.names)))

    def reach(self, words: int) -> int:
        """How many places belong to documents of at least that many words."""
        return int(self.edge[np.searchsorted(-self.sizes, -words, side="right")])

    def agree(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``a`` and from ``b`` > ``a`` on are equal (before them if not forward)."""
        length = np.zeros(len(a), dtype=np.int64)
        begin, end = self.begin[a], self.end[a]
        for level, names in reversed(list(enumerate(self.names))):
            step = 1 << level
            if forward:
                at, to = a + length, b + length
                fits = to + step <= end
            else:
                at, to = a - length - step, b - length - step
                fits = at >= begin
            fits &= to < len(names)
            fits[fits] = names[at[fits]] == names[to[fits]]
            length += np.where(fits, step, 0)
        return length


def _equal_neighbours(texts: _Texts) -> np.ndarray:
    """Stretches of at least EXPONENT equal words: (start, length, 1)."""
    n = len(texts.rank)
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = texts.rank[1:] != texts.rank[:-1]
    fresh[texts.edge[:-1][texts.sizes > 0]] = True
    start = np.flatnonzero(fresh)
    length = np.diff(np.append(start, n))
    long = length >= EXPONENT
    return np.stack([start[long], length[long], np.ones(long.sum(), dtype=np.int64)], axis=1)


def synchronising(texts: _Texts, level: int, reach: int, runs: np.ndarray) -> np.ndarray:
    """The synchronising positions of scale 2**level among the first ``reach`` places."""
    tau = 1 << level
    names = texts.names[level][:reach] >> U64(1)
    end = texts.end[:reach]
    place = np.arange(reach)
    names[place + tau > end] = _NONE
    periodic = runs[(4 * runs[:, 2] <= tau) & (runs[:, 1] >= tau)]
    periodic = periodic[periodic[:, 0] < reach]
    if len(periodic):
        change = np.zeros(reach + 1, dtype=np.int64)
        np.add.at(change, periodic[:, 0], 1)
        np.add.at(change, periodic[:, 0] + periodic[:, 1] - tau + 1, -1)
        names[np.cumsum(change[:-1]) > 0] = _NONE
    least, width = names, 1
    while width < tau:
        least = np.minimum(least, _ahead(least, width, reach, _NONE))
        width *= 2
    least = np.minimum(least, _ahead(names, tau, reach, _NONE))
    chosen = ((least == names) | (least == _ahead(names, tau, reach, _NONE))) & (least != _NONE)
    return np.flatnonzero(chosen & (place + 2 * tau <= end))


def _proposals(texts: _Texts, level: int, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions with equal contexts, 1.5 tau up to 3 tau apart."""
    tau = 1 << level
    context = texts.names[level + 1][position]
    order = np.argsort(context, kind="stable")
    context, position = context[order], position[order]
    left = np.arange(len(position))
    found, by = [], 1
    while len(left):
        left = left[left + by < len(position)]
        apart = position[left + by] - position[left]
        near = (context[left + by] == context[left]) & (apart < 3 * tau)
        left, apart = left[near], apart[near]
        good = (2 * apart >= 3 * tau) & (position[left + by] + 2 * tau <= texts.end[position[left]])
        found.append((position[left[good]], position[left[good] + by]))
        by += 1
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _found(texts: _Texts) -> np.ndarray:
    runs = _equal_neighbours(texts)
    level = 0
    while (reach := texts.reach(6 << level)):
        a, b = _proposals(texts, level, synchronising(texts, level, reach, runs))
        if len(a):
            period = b - a
            start = a - texts.agree(a, b, forward=False)
            length = b + texts.agree(a, b, forward=True) - start
            long = length >= EXPONENT * period
            fresh = np.unique(np.stack([start[long], length[long], period[long]], axis=1), axis=0)
            width = len(texts.rank) + 1
            known = np.isin(fresh[:, 0] * width + fresh[:, 1], runs[:, 0] * width + runs[:, 1])
            runs = np.concatenate([runs, fresh[~known]])
        level += 1
    return runs


def _hold(texts: _Texts, runs: np.ndarray) -> bool:
    """Whether the words of every run repeat with its period and its neighbours do not."""
    if not len(runs):
        return True
    start, length, period = runs.T
    size = length - period
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    rank, stop = texts.rank, start + length
    before = start > texts.begin[start]
    after = stop < texts.end[start]
    return bool((rank[at] == rank[at + np.repeat(period, size)]).all()
                and (rank[start[before] - 1] != rank[start[before] + period[before] - 1]).all()
                and (rank[stop[after]] != rank[stop[after] - period[after]]).all())


def maximal_runs(rank: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of documents whose words are ``rank[first[i]:first[i + 1]]``: their documents, and
    (start in the document, length, period), ordered by document, start and period."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    at = np.repeat(first[order] - (np.cumsum(sizes[order]) - sizes[order]), sizes[order]) + np.arange(len(rank))
    salt = 1
    while True:
        texts = _Texts(rank[at], sizes[order], salt)
        runs = _found(texts)
        if _hold(texts, runs):
            break
        salt += 1
    runs = runs[runs[:, 1] >= SHORTEST]
    where = np.searchsorted(texts.edge, runs[:, 0], side="right") - 1
    runs[:, 0] -= texts.edge[where]
    document = order[where]
    by = np.lexsort((runs[:, 2], runs[:, 0], document))
    return document[by], runs[by]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def _collapsed(part: pa.Array, document: np.ndarray, runs: np.ndarray) -> list[str]:
    data, offsets = buffers(part)
    cut = np.searchsorted(document, np.arange(len(part) + 1))
    texts = []
    for i in range(len(part)):
        words = data[offsets[i]:offsets[i + 1]].tobytes().split()
        if cut[i] < cut[i + 1]:
            change = np.zeros(len(words) + 1, dtype=np.int64)
            start, length, period = runs[cut[i]:cut[i + 1]].T
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            words = compress(words, (np.cumsum(change[:-1]) == 0).tolist())
        texts.append(b" ".join(words).decode())
    return texts


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = words_of(part.column("text"))
            document, runs = maximal_runs(word_ranks(words), words.first)
            offsets = np.searchsorted(document, np.arange(part.num_rows + 1)).astype(np.int32)
            found = pa.ListArray.from_arrays(
                pa.array(offsets), pa.StructArray.from_arrays([pa.array(c) for c in runs.T], fields=list(_RUN)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(words.first)), found,
                 pa.array(_collapsed(part.column("text"), document, runs), type=pa.string())], schema=_SCHEMA)


def find_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, its runs (start, length, period; by start, then period)
    and the text without the words that any run contains after its first period, joined by one space."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _detect, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts, chosen by the CRC-32 h of the decimal identifier,
    turn periodic: with g = h div 10, word i from a = g mod n on becomes word a + (i - a) mod p,
    p = 1 + (n - a) div (3 + g mod 8). A null identifier changes nothing."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(hashed / 10)

    def periodic(words):
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                            lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(place, " "))

    # the words are bound once, as the only element of an array
    words = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    return docs.select("doc_id", F.when(hashed % 10 == 0, F.get(F.transform(words, periodic), F.lit(0)))
                       .otherwise(F.col("text")).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest (ties: smallest start, then period) and digests of
    all runs and of the collapsed text."""
    best = F.reduce(
        "runs", F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda held, run: F.when(held.isNull() | (run["length"] > held["length"]), run).otherwise(held))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
