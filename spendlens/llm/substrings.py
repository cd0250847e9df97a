"""Exact substring deduplication by recompression.

A document's words are rewritten in rounds. A round names every run of one symbol, then every pair
of neighbours whose left symbol falls in the left half of all names and whose right symbol in the
right half. Halves and names are functions of the symbols alone, so naming is global without a
dictionary to agree on: equal substrings of any two documents get the same interior symbols. Each
boundary between symbols carries the words that its survival up to a level depends on; a boundary
whose words lie inside a window is the same in every occurrence of that window. Every window of
``window`` words is filed under one of its highest such boundaries (the first by the name of the two
words it parts), whose key names the words it depends on: the shared high-level symbols.

1. A key that occurs once in the corpus settles all windows filed under it: they occur once. For a
   shared key, the name of the whole stretch of those windows is compared as well; if that occurs
   elsewhere, all of them do. Windows that contain no such boundary (inside a long run) count as
   under a shared key.
2. Windows left open are named one by one (96 bits) and counted over the corpus. A repeated stretch
   takes part once, by its first occurrence: one of its windows may occur in another stretch.
3. Words covered by a window that occurs anywhere else, in the same document or another, go.

Before every shuffle a task merges what is equal in its part of the text: what it sees twice it knows
to be repeated, and it sends one witness. So a passage in a third of all documents crosses the
network once per part, not once per document. Windows are judged on the input. Null has no words.
Documents are told apart by their place in the table's files, so equal identifiers do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.staging import staged
from .shipping import ship, small_batches
from .words import U64, Words, join_names, release, scramble, slices, words_of

WINDOW = 35
ROUNDS = 3
#: A boundary's level counts from here: below it, its words say too little.
LOWEST = 2
_FAR = 1 << 40
#: Bytes of text whose words are worked on at a time; what is equal is merged over larger parts.
STEP_BYTES = 1 << 19


def _merge(keep: np.ndarray, start, low, high, inner_low, inner_high):
    """Contexts after the boundaries that are not in ``keep`` are gone: theirs go to the symbol
    that swallows them."""
    at = np.flatnonzero(keep)
    both_low = np.minimum(inner_low, np.where(keep, _FAR, low))
    both_high = np.maximum(inner_high, np.where(keep, -_FAR, high))
    return start[at], low[at], high[at], np.minimum.reduceat(both_low, at), np.maximum.reduceat(both_high, at)


def boundaries(words: Words, rounds: int = ROUNDS):
    """For each level: (place, low, high) of the boundaries that survive to it. Words low..high-1
    decide that; a document's edge puts them out of reach of any window."""
    n = len(words.names)
    name = words.names
    start = np.arange(n)
    edge = np.zeros(n, dtype=bool)
    edge[words.first[:-1][words.first[:-1] < words.first[1:]]] = True
    low, high = start.copy(), start.copy()  # between words there always is a boundary, also at an edge
    end_low = end_high = n
    inner_low, inner_high = start.copy(), start + 1  # a word is decided by itself
    levels = []
    for level in range(rounds):
        for pairs in (False, True):
            if not len(start):
                break
            # what lies left and right of each boundary, and how far those symbols are decided
            left = np.concatenate([name[:1], name[:-1]])
            if pairs:
                side = scramble(name + U64(level * 2 + 77)) >> U64(63)
                gone = (np.concatenate([side[:1], side[:-1]]) == 0) & (side == 1) & ~edge
            else:
                gone = (left == name) & ~edge
            before = np.arange(len(start)) - 1
            before[0] = 0
            next_low = np.append(low[1:], end_low)
            next_high = np.append(high[1:], end_high)
            end_low, end_high = -_FAR, _FAR  # that it survives at an edge is due to the edge
            low, high = (
                np.where(edge, -_FAR, np.minimum.reduce([low, low[before], inner_low[before], inner_low, next_low])),
                np.where(edge, _FAR, np.maximum.reduce([high, high[before], inner_high[before], inner_high, next_high])))
            keep = ~gone
            at = np.flatnonzero(keep)
            sizes = np.diff(np.append(at, len(start)))
            if pairs:
                fresh = name[at]
                two = sizes == 2
                fresh[two] = join_names(name[at[two]], name[at[two] + 1], 2 + level)
            else:
                fresh = name[at]
                many = sizes > 1
                fresh[many] = join_names(name[at[many]], sizes[many].astype(np.uint64), 1000 + level)
            edge = edge[at]
            start, low, high, inner_low, inner_high = _merge(keep, start, low, high, inner_low, inner_high)
            name = fresh
        levels.append((start, low, high))
    return levels


def _range_names(names: np.ndarray, begin: np.ndarray, size: np.ndarray, salt: int) -> np.ndarray:
    """The names of word ranges, from the names of their halves in powers of two."""
    result = scramble(size.astype(np.uint64) + U64(salt))
    place, left, power, span = begin.copy(), size.copy(), names, 1
    while len(left) and left.any():
        odd = (left & 1) == 1
        result[odd] = join_names(result[odd], power[place[odd]], salt)
        place = place + np.where(odd, span, 0)
        left = left >> 1
        if not left.any():
            break
        power = np.concatenate([join_names(power[:-span], power[span:], salt), power[-span:]]) if len(power) > span else power
        span *= 2
    return result


class Filed:
    """The windows of some documents, in stretches filed under one boundary each: ``begin``/``end``
    of the window starts, ``key`` and whether the boundary is ``weak`` (there is none)."""

    def __init__(self, words: Words, window: int):
        counts = np.diff(words.first)
        n = len(words.names)
        document = np.repeat(np.arange(len(counts)), counts)
        filed = np.full(n + 1, -1, dtype=np.int64)
        windows = np.zeros(n + 1, dtype=bool)  # starts of windows
        if n >= window:
            windows[:n - window + 1] = document[:n - window + 1] == document[window - 1:]
        open_ = windows.copy()
        lows, highs, total = [], [], 0
        levels = boundaries(words)
        for start, low, high in reversed(levels[LOWEST - 1:]):
            usable = (low >= 0) & (high <= n) & (high - low <= window)
            start, low, high = start[usable], low[usable], high[usable]
            if not len(start):
                continue
            # a boundary lies in the windows that begin from high - window to low; they are painted
            # from the last boundary by name to the first, so the first stays
            order = np.argsort(join_names(words.names[start - 1], words.names[start], 5), kind="stable")[::-1]
            begin = np.maximum(high[order] - window, 0)
            size = low[order] + 1 - begin
            where = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            paint = np.full(n + 1, -1, dtype=np.int64)
            paint[where] = np.repeat(total + order, size)
            here = open_ & (paint >= 0)
            filed[here] = paint[here]
            open_ &= ~here
            lows.append(low)
            highs.append(high)
            total += len(start)
        low = np.concatenate(lows) if lows else np.zeros(0, dtype=np.int64)
        high = np.concatenate(highs) if highs else np.zeros(0, dtype=np.int64)
        changed = np.ones(n + 1, dtype=bool)
        changed[1:] = (filed[1:] != filed[:-1]) | (windows[1:] != windows[:-1]) | (
            np.append(document, -1)[1:] != np.append(document, -1)[:-1])
        at = np.flatnonzero(changed)
        at = at[windows[at]]
        ends = np.append(np.flatnonzero(changed), n + 1)
        self.begin, self.end = at, ends[np.searchsorted(ends, at, side="right")]
        which = filed[at]
        self.weak = which < 0
        key_low = np.where(self.weak, at, low[which] if len(low) else at)
        key_high = np.where(self.weak, at, high[which] if len(high) else at)
        self.key = _range_names(words.names, key_low, key_high - key_low, 11)
        self.stretch = _range_names(words.names, self.begin, self.end - self.begin + window - 1, 13)
        self.document = document[at] if n else at


def _counts_here(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each value occurs in the part, and whether it is its first place."""
    _, first, back, counts = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
    lead = np.zeros(len(values), dtype=bool)
    lead[first] = True
    return counts[back], lead


_STRETCHES = pa.schema([("deal", pa.int64()), ("stretch", pa.int64()), ("known", pa.int8()), ("place", pa.int64()),
                        ("begin", pa.int32()), ("end", pa.int32())])
#: known: 0 nothing, 1 the key is shared, 2 all windows are repeated, 3 the same and the first such
#: stretch of its part; a witness has no place. The row that a key's witness with known = 1 stands for is
#: dealt by its stretch and does not meet it: the witness shows a repeat, but never takes the turn to be named.


def _stretches(part: pa.RecordBatch, window: int) -> tuple[np.ndarray, ...]:
    """Of all windows of a part: key, stretch, weak, place of the document, begin and end in it."""
    found = []
    for step in slices(part, "text", STEP_BYTES):
        words = words_of(step.column("text"))
        filed = Filed(words, window)
        base = words.first[filed.document]
        found.append((filed.key, filed.stretch, filed.weak, step.column("place").to_numpy()[filed.document],
                      filed.begin - base, filed.end - base))
    return tuple(np.concatenate(x) for x in zip(*found))


def _file_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                key, stretch, weak, place, begin, end = _stretches(part, window)
                if not len(begin):
                    continue
                of_key, key_lead = _counts_here(key)
                of_stretch, stretch_lead = _counts_here(stretch)
                shared = (of_key > 1) | weak
                known = np.where(of_stretch > 1, 2 + stretch_lead, np.where(shared, 1, 0)).astype(np.int8)
                key, stretch = key.view(np.int64), stretch.view(np.int64)
                alone = scramble(place.astype(np.uint64) * U64(0x9E3779B97F4A7C15) + begin.astype(np.uint64)).view(np.int64)
                deal = np.where(known == 0, key, np.where(known == 1, stretch, alone))
                yield _rows(deal, stretch, known, place, begin, end)
                witness = (of_key > 1) & key_lead  # for those who know of one only
                yield _rows(key[witness], stretch[witness], known[witness], None, begin[witness], begin[witness])
                witness = (of_stretch > 1) & stretch_lead
                yield _rows(stretch[witness], stretch[witness], known[witness], None, begin[witness], begin[witness])
        release()

    return run


def _rows(deal, stretch, known, place, begin, end) -> pa.RecordBatch:
    place = pa.array(place, pa.int64()) if place is not None else pa.nulls(len(deal), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(deal), pa.array(stretch), pa.array(known, pa.int8()), place, pa.array(begin, pa.int32()),
         pa.array(end, pa.int32())], schema=_STRETCHES)


_WINDOWS = pa.schema([("name", pa.int64()), ("more", pa.int32()), ("known", pa.bool_()), ("place", pa.int64()),
                      ("begin", pa.int32()), ("end", pa.int32())])


def _open_windows(part: pa.RecordBatch, window: int) -> tuple[np.ndarray, ...]:
    """Of the windows left open: name, more of the name, place of the document, begin in it."""
    found = []
    for step in slices(part, "text", STEP_BYTES):
        words = words_of(step.column("text"))
        spans = step.column("open")
        flat = spans.flatten()
        counts = np.diff(np.asarray(spans.offsets))
        owner = np.repeat(np.arange(step.num_rows), counts)
        begin, end = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
        size = end - begin
        doc = np.repeat(owner, size)
        start = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        at = start + words.first[doc]
        length = np.full(len(at), window)
        found.append((_range_names(words.names, at, length, 17).view(np.int64),
                      (_range_names(words.names, at, length, 19) >> U64(33)).astype(np.int32),
                      step.column("place").to_numpy()[doc], start))
    return tuple(np.concatenate(x) for x in zip(*found))


def _name_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                name, more, place, start = _open_windows(part, window)
                if not len(start):
                    continue
                here, lead = _counts_here(name)
                known = here > 1
                alone = scramble(place.astype(np.uint64) * U64(0x9E3779B97F4A7C15) + start.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(known, alone, name)), pa.array(more), pa.array(known), pa.array(place),
                     pa.array(start, pa.int32()), pa.array(start + 1, pa.int32())], schema=_WINDOWS)
                lead &= known
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name[lead]), pa.array(more[lead]), pa.array(known[lead]), pa.nulls(int(lead.sum()), pa.int64()),
                     pa.array(start[lead], pa.int32()), pa.array(start[lead], pa.int32())], schema=_WINDOWS)
        release()

    return run


_KEPT = pa.schema([("place", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                   ("kept", pa.large_string())])


def _gone(words: Words, spans: pa.ListArray, window: int) -> np.ndarray:
    """Which words a repeated window covers."""
    marks = np.zeros(len(words.names) + 1, dtype=np.int64)
    flat, counts = spans.flatten(), np.diff(np.asarray(spans.offsets))
    counts[np.asarray(spans.is_null())] = 0
    base = np.repeat(words.first[:-1], counts)
    begin, end = (flat.field(i).to_numpy().astype(np.int64) + base for i in (0, 1))
    np.add.at(marks, begin, 1)
    np.add.at(marks, end + window - 1, -1)
    return np.cumsum(marks[:-1]) > 0


def _left(words: Words, gone: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """For each text the number of words that go, and the others joined by one space."""
    raw, starts, ends = words.data.tobytes(), words.start, words.end
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        left = np.flatnonzero(~gone[a:b]) + a
        yield b - a - len(left), b" ".join([raw[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist())])


def _remove(window: int, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                words = words_of(part.column("text"))
                removed, kept = zip(*_left(words, _gone(words, part.column("spans"), window)))
                kept = [hashlib.sha256(text).hexdigest() if digests else text.decode() for text in kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column("place"), part.column("doc_id"), pa.array(np.diff(words.first), pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(kept, pa.large_string())], schema=_KEPT)
        release()

    return run


def _rewrite(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                words = words_of(part.column("text"))
                texts = part.column("text").to_pylist()
                for i, (removed, text) in enumerate(_left(words, _gone(words, part.column("_spans"), window))):
                    if removed:
                        texts[i] = text.decode()
                at = part.schema.get_field_index("text")
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
        release()

    return run




def _place():
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def _on_file(docs: DataFrame) -> bool:
    """Whether the rows have a place: a plain scan of files."""
    try:
        docs.select(_place())
        return True
    except AnalysisException:
        return False


def _placed(docs: DataFrame) -> DataFrame:
    """place, doc_id and text. The place names the row: its file and its number there."""
    wanted = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if not _on_file(docs):
        docs = staged(docs.select(*wanted), "content")
    return docs.select(_place().alias("place"), *wanted)


def remove_repeats(docs: DataFrame, window: int = WINDOW, digests: bool = False) -> DataFrame:
    """One row per document: place, doc_id, n_words, n_removed, kept (the words that stay, joined by
    one space; with ``digests`` their SHA-256 in lowercase hex)."""
    found, texts = _repeats(docs, window)
    none = F.array().cast("array<struct<begin:int,end:int>>")
    return texts.join(found, "place", "left").select("place", "doc_id", "text", F.coalesce("spans", none).alias("spans")).mapInArrow(
        _remove(window, digests), "place long, doc_id long, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, their texts without repeated words (see remove_repeats); a
    text that loses none is left as it is."""
    placed = staged(docs, "content") if not _on_file(docs) else docs
    found, _ = _repeats(placed, window)
    columns = placed.columns
    spans = found.withColumnsRenamed({"place": "_place", "spans": "_spans"}).filter("size(_spans) > 0")
    here = placed.withColumn("_place", _place()).join(spans, "_place", "left")
    return here.mapInArrow(_rewrite(window), here.schema).select(*columns)


def _repeats(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(place, spans of the starts of repeated windows) where there are any, and the texts by place."""
    ship(docs.sparkSession)
    rows = _placed(docs)
    stretches = rows.select("place", "text").mapInArrow(
        _file_windows(window), "deal long, stretch long, known byte, place long, begin int, end int")
    per_deal, per_stretch = Window.partitionBy("deal"), Window.partitionBy("deal", "stretch")
    judged = (stretches
              .withColumn("same", F.count(F.lit(1)).over(per_stretch))
              .withColumn("turn", F.row_number().over(per_stretch.orderBy(F.expr("place IS NULL AND known < 2"), "place")))
              .withColumn("met", F.count(F.lit(1)).over(per_deal))
              .filter("place IS NOT NULL AND (known > 0 OR met > 1)")
              .withColumn("done", F.expr("known >= 2 OR same > 1"))
              .withColumn("named", F.expr("NOT done OR known = 3 OR (known < 2 AND turn = 1)")))
    span = F.struct("begin", "end")
    with small_batches(docs.sparkSession):
        spans = staged(judged.groupBy("place").agg(
            F.collect_list(F.when(F.col("done"), span)).alias("spans"),
            F.collect_list(F.when(F.col("named"), span)).alias("open")), "spans")

    texts = rows.repartition("place")
    windows = texts.join(spans.filter("size(open) > 0").select("place", "open"), "place").select(
        "place", "text", "open").mapInArrow(
        _name_windows(window), "name long, more int, known boolean, place long, begin int, end int")
    met = F.count(F.lit(1)).over(Window.partitionBy("name", "more"))
    late = (windows.withColumn("met", met).filter("place IS NOT NULL AND (known OR met > 1)")
            .groupBy("place").agg(F.collect_list(span).alias("late")))
    none = F.array().cast("array<struct<begin:int,end:int>>")
    found = spans.join(late, "place", "left").select(
        "place", F.concat("spans", F.coalesce("late", none)).alias("spans"))
    return found, texts
