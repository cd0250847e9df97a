"""Byte-level BPE, encoded with a pair occurrence index and decoded again.

The distinct new pre-tokens of a part of a partition stand in one symbol list. An index maps each
adjacent pair that has a merge to all its positions; the ranks that occur are taken in ascending
order, all positions of a pair are merged from left to right, and only the lists of the pairs beside
a merge are updated. Pre-tokens repeat, so a worker keeps the ids of those it has seen, up to a
bound. Null counts as empty, an empty text has no ids; extra columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segments import SegmentCache, vocabulary_path
from .shipping import ship
from .words import slices

#: How the byte-level tokenizer forms pre-tokens (a fixed value, it must equal the tokenizer's own).
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes are
    themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class PairIndexBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.text |= {i: content.encode() for content, i in self.special.items()}
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        self.ranks: dict[int, int] = {}  # by left << 32 | right
        self.merged: list[tuple[int, int, int]] = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks.setdefault(vocab[left] << 32 | vocab[right], rank)
            self.merged.append((vocab[left], vocab[right], vocab[left + right]))
        self.first_symbols = np.array([*self.byte_ids, -1])
        self.first_ranks = np.array([[self.ranks.get(a << 32 | b, -1) for b in self.byte_ids] + [-1] for a in self.byte_ids]
                                    + [[-1] * 257])

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each pre-token."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        codes = np.full(int(ends[-1]) + 1 if len(words) else 0, 256, dtype=np.int64)  # 256: the end of a word
        inside = np.ones(len(codes), dtype=bool)
        inside[ends] = False
        codes[inside] = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols: list[int] = self.first_symbols[codes].tolist()
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        first = self.first_ranks[codes[:-1], codes[1:]]
        paired = np.flatnonzero(first >= 0)
        paired = paired[np.argsort(first[paired], kind="stable")]
        ranks, starts = np.unique(first[paired], return_index=True)
        # the pair occurrence index, by the pair's rank
        where: dict[int, list[int]] = {r: p.tolist() for r, p in zip(ranks.tolist(), np.split(paired, starts[1:]))}
        get, merged = self.ranks.get, self.merged
        active = list(where)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            left, right, new = merged[rank]
            high = new << 32
            positions = where.pop(rank)
            positions.sort()
            for position in positions:
                if symbols[position] != left:
                    continue  # taken by an earlier merge
                follower = after[position]
                if symbols[follower] != right:
                    continue
                symbols[position], symbols[follower] = new, -2
                beyond = after[position] = after[follower]
                before[beyond] = position
                symbol = symbols[beyond]
                if symbol >= 0:
                    other = get(high | symbol)
                    if other is not None:
                        if other in where:
                            where[other].append(position)
                        else:
                            where[other] = [position]
                            heapq.heappush(active, other)
                ahead = before[position]
                if ahead >= 0 and symbols[ahead] >= 0:
                    other = get(symbols[ahead] << 32 | new)
                    if other is not None:
                        if other in where:
                            where[other].append(ahead)
                        else:
                            where[other] = [ahead]
                            heapq.heappush(active, other)
        left_over = np.array(symbols, dtype=np.int64)
        kept = left_over >= 0
        ids, edges = left_over[kept].tolist(), np.concatenate([[0], np.cumsum(kept)[ends]]).tolist()
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]


class _Coder:
    """Segments to (number of ids, ids as text, their bytes). Pre-tokens are cached like segments."""

    def __init__(self, vocabulary: str, limit: int = 400_000):
        self.bpe = PairIndexBPE(vocabulary_path(vocabulary))
        self.decimal = {i: str(i) for i in self.bpe.text}
        self.cache = SegmentCache(self.encode, list(self.bpe.special), limit)
        self.words: dict[str, tuple[int, str, bytes]] = {}
        self.limit = limit

    def encode(self, segments: list[str]) -> list[tuple[int, str, bytes]]:
        if len(self.words) > self.limit:
            self.words = {}
        words, special = self.words, self.bpe.special
        split = [[] if s in special else PRE_TOKEN.findall(s) for s in segments]
        new = sorted({w for found in split for w in found}.difference(words))
        text, decimal = self.bpe.text, self.decimal
        for word, ids in zip(new, self.bpe.encode([w.encode() for w in new])):
            words[word] = (len(ids), ",".join([decimal[i] for i in ids]), b"".join([text[i] for i in ids]))
        result = []
        for segment, found in zip(segments, split):
            if len(found) == 1:
                result.append(words[found[0]])
            elif found:
                sizes, ids, pieces = zip(*[words[w] for w in found])
                result.append((sum(sizes), ",".join(ids), b"".join(pieces)))
            else:
                result.append((1, str(special[segment]), text[special[segment]]))
        return result


_coders: dict[str, _Coder] = {}

_CODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.large_string()),
                    ("decoded", pa.large_string())])


def _code(vocabulary: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coders.get(vocabulary) or _coders.setdefault(vocabulary, _Coder(vocabulary))
        gc.disable()  # the caches hold no cycles, and walking them again and again costs a tenth of the time
        try:
            yield from code(coder, batches)
        finally:
            gc.enable()

    def code(coder: _Coder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, ids, texts = [], [], []
                for values in coder.cache.values([t or "" for t in part.column("text").to_pylist()]):
                    counts, numbers, pieces = zip(*values) if values else ((), (), ())
                    sizes.append(sum(counts))
                    ids.append(",".join(numbers))
                    texts.append(b"".join(pieces).decode("utf-8", "replace"))
                if digests:
                    ids = [hashlib.sha256(x.encode()).hexdigest() for x in ids]
                    texts = [hashlib.sha256(x.encode()).hexdigest() for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.large_string()),
                     pa.array(texts, pa.large_string())], schema=_CODED)

    return run


def round_trip(docs: DataFrame, vocabulary: str, digests: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (decimal, joined by commas) and decoded (the
    text made from the ids); with ``digests`` the SHA-256 of both instead, in lowercase hex."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _code(vocabulary, digests), "doc_id long, n_tokens long, ids string, decoded string")
