"""Language identification by unigram pieces, summed over all segmentations.

A word (with the space before it, lower case) can be cut into pieces of a fixed public vocabulary in
many ways. A language gives every piece a probability; the probability of a word is the sum, over all
its segmentations, of the product of its pieces, which a forward pass over the bytes computes without
listing them. Every single byte is a piece too, so every word has a segmentation. A text's words are
independent, so its log likelihood is the sum over its words, each taken as often as it occurs.

The pieces' probabilities are fitted by expectation maximisation: a forward and a backward pass give
how often each piece is expected in the words of a language. Learning reads a sample of the labelled
texts of each language of about ``SAMPLE_BYTES`` bytes, chosen by a hash of the text: all of them if
there are fewer. The sample's words are counted by Spark, every round is a Spark job over these counts,
and what comes to the driver is one number per language and piece.

Null texts and texts without a letter are ``und`` with score 0; so is every text if nothing could be
learned (an empty table). A null doc_id counts as the empty string where texts are held out. Repeated
rows count each. Texts are scored whole, in memory that grows with the longest text of a batch only;
ties go to the language whose name is smaller. Words are told apart by names of 64 bits. The columns lang, source and doc_id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import staged, work_folder
from .segments import vocabulary_path
from .shipping import open_store, ship
from .words import U64, slices, words_of

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_BYTES = 3 << 20
ROUNDS = 3
#: Languages a model may hold: it has one number per language and piece.
MOST_LANGUAGES = 200
#: Expected counts are raised by this before they are normed.
SMOOTHING = 0.05
LONGEST_PIECE = 24
_SLICE = 4 << 20
#: Numbers held at once: by the cache of a worker (words x languages), by the passes over some words.
_CACHED = 1_600_000
_AREA = 2_000_000


def pieces_of(vocabulary: str) -> list[bytes]:
    """The vocabulary's pieces as bytes, a space for the mark of a word's begin; all single bytes
    first. Pieces that no word can hold (several marks) and those longer than LONGEST_PIECE are out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(vocabulary))
    found = {model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    multi = sorted(p for p in found if 1 < len(p) <= LONGEST_PIECE and b" " not in p[1:])
    return [bytes([b]) for b in range(256)] + multi


class Pieces:
    """The pieces as a trie whose edges lie in a hash table: ``follow`` takes many steps at once."""

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        node_of: dict[bytes, int] = {b"": 0}
        edges: list[tuple[int, int, int]] = []
        piece_at = [-1]
        for number, piece in enumerate(pieces):
            for i in range(1, len(piece) + 1):
                if piece[:i] not in node_of:
                    node_of[piece[:i]] = len(piece_at)
                    edges.append((node_of[piece[:i - 1]], piece[i - 1], len(piece_at)))
                    piece_at.append(-1)
            piece_at[node_of[piece]] = number
        self.piece = np.array(piece_at, dtype=np.int64)
        self.bits = max(4, int(np.ceil(np.log2(4 * len(edges) + 1))))
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.to = np.zeros(1 << self.bits, dtype=np.int64)
        source, byte, target = (np.array(x, dtype=np.int64) for x in zip(*edges))
        key = source << 8 | byte
        at, waiting = self._slot(key), np.arange(len(key))
        while len(waiting):  # linear probing, all keys a step at a time
            free = self.keys[at[waiting]] < 0
            _, first = np.unique(at[waiting[free]], return_index=True)
            set_now = waiting[free][first]
            self.keys[at[set_now]], self.to[at[set_now]] = key[set_now], target[set_now]
            waiting = waiting[self.keys[at[waiting]] != key[waiting]]
            at[waiting] = (at[waiting] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def follow(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The node after ``byte``, -1 if there is none."""
        key = node << 8 | byte
        at = self._slot(key)
        found = np.where(self.keys[at] == key, self.to[at], -1)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[at[open_]]
            hit = held == key[open_]
            found[open_[hit]] = self.to[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return found

    def matches(self, data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in ``data``: (where, length, piece); ``end`` is the end of the word at a byte."""
        where = np.arange(len(data))
        node = np.zeros(len(data), dtype=np.int64)
        found, length = [], 0
        while len(where):
            node = self.follow(node, data[where + length])
            length += 1
            alive = node >= 0
            where, node = where[alive], node[alive]
            piece = self.piece[node]
            hit = piece >= 0
            found.append((where[hit], np.full(hit.sum(), length), piece[hit]))
            inside = where + length < end[where]
            where, node = where[inside], node[inside]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, dtype=np.int64),) * 3


class Lattice:
    """The segmentations of some words: pieces by the position at which they end or begin, so a step
    of the passes takes all words at once. ``data`` holds the words one after another, ``edge`` where
    each begins (and the end); longer words first."""

    def __init__(self, pieces: Pieces, data: np.ndarray, edge: np.ndarray):
        self.size = np.diff(edge)
        begin = np.repeat(edge[:-1], self.size)
        where, length, self.piece = pieces.matches(data.astype(np.int64), np.repeat(edge[1:], self.size))
        self.word = np.repeat(np.arange(len(self.size)), self.size)[where]
        self.begin = where - begin[where]
        self.end = self.begin + length
        self.longest = int(self.size.max(initial=0))

    def _steps(self, at: np.ndarray, backward: bool):
        order = np.argsort(at, kind="stable")
        cut = np.searchsorted(at[order], np.arange(self.longest + 2))
        for t in (range(self.longest - 1, -1, -1) if backward else range(1, self.longest + 1)):
            yield t, order[cut[t]:cut[t + 1]]

    def _pass(self, chance: np.ndarray, backward: bool):
        """Per position, word and language the scaled sum over the segmentations before (after) it,
        and the logarithm of the scale."""
        n, languages = len(self.size), chance.shape[1]
        reach = LONGEST_PIECE + 1
        ring = np.zeros((reach, n, languages))  # the last positions only; scaled alike
        scale = np.zeros((n, languages))
        active_of = lambda t: int(np.searchsorted(-self.size, -t, side="right"))  # words of at least t bytes
        if not backward:
            ring[0] = 1.0
        for t, chosen in self._steps(self.begin if backward else self.end, backward):
            if backward:  # words of exactly t + 1 bytes begin their way here
                fresh = slice(active_of(t + 2), active_of(t + 1))
                ring[:, fresh] = 0.0
                ring[(t + 1) % reach, fresh] = 1.0
            active = active_of(max(t, 1)) if not backward else active_of(t + 1)
            word, from_ = self.word[chosen], (self.end if backward else self.begin)[chosen]
            value = ring[from_ % reach, word] * chance[self.piece[chosen]]
            total = np.empty((active, languages))
            for k in range(languages):
                total[:, k] = np.bincount(word, weights=value[:, k], minlength=active)[:active]
            ring[t % reach, :active] = total
            if t % 8 == 0:
                by = np.where(total > 0, total, 1.0)
                ring[:, :active] /= by
                scale[:active] += np.log(by)
                total = ring[t % reach, :active]
            yield t, active, total, scale

    def log_chances(self, chance: np.ndarray) -> np.ndarray:
        """The log probability of every word in every language."""
        result = np.zeros((len(self.size), chance.shape[1]))
        for t, active, total, scale in self._pass(chance, backward=False):
            done = slice(int(np.searchsorted(-self.size, -t, side="left")), active)
            result[done] = np.log(total[done]) + scale[done]
        return result

    def expected(self, chance: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often every piece is expected in the words, word i taken ``times[i]`` times; one language."""
        fits = self.longest + 1
        ahead, behind = (np.full((len(self.size), fits), -np.inf) for _ in range(2))
        ahead[:, 0] = 0.0
        behind[np.arange(len(self.size)), self.size] = 0.0
        with np.errstate(divide="ignore"):
            for table, backward in ((ahead, False), (behind, True)):
                for t, active, total, scale in self._pass(chance, backward):
                    table[:active, t] = np.log(total[:, 0]) + scale[:active, 0]
        part = ahead[self.word, self.begin] + behind[self.word, self.end] + np.log(chance[self.piece, 0]) - behind[self.word, 0]
        return np.bincount(self.piece, weights=np.exp(part) * times[self.word], minlength=len(chance))


def _lattice(pieces: Pieces, words: list[bytes]) -> tuple[Lattice, np.ndarray]:
    """The lattice of the words and its order: row i is word order[i]."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(-size, kind="stable")
    data = np.frombuffer(b"".join(words[i] for i in order.tolist()), dtype=np.uint8)
    return Lattice(pieces, data, np.concatenate([[0], np.cumsum(size[order])])), order


@dataclass(frozen=True)
class Model:
    """``folder`` holds the table of piece probabilities, one column per language."""

    languages: list[str]
    vocabulary: str
    folder: str


_loaded: dict[str, tuple[Pieces, np.ndarray]] = {}


def _pieces(vocabulary: str) -> Pieces:
    if vocabulary not in _loaded:
        _loaded[vocabulary] = Pieces(pieces_of(vocabulary)), None
    return _loaded[vocabulary][0]


def _words_counted(docs: DataFrame) -> DataFrame:
    """lang, word, times, of texts in lower case."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                for lang in part.column("lang").unique().to_pylist():
                    rows = part.filter(pa.compute.equal(part.column("lang"), lang))
                    words = words_of(rows.column("text"))
                    _, first, times = np.unique(words.names, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(first), type=pa.string()),
                        pa.array([words.text(i) for i in first.tolist()], type=pa.binary()), pa.array(times)],
                        names=["lang", "word", "times"])

    parts = docs.select("lang", "text").mapInArrow(count, "lang string, word binary, times long")
    return parts.groupBy("lang", "word").agg(F.sum("times").alias("times"))


def _expected_counts(words: DataFrame, model_of, vocabulary: str, languages: list[str]) -> np.ndarray:
    """One round: expected counts (pieces x languages), summed by Spark."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(vocabulary)
        chance = model_of(pieces.size)
        for batch in batches:
            column = batch.column("lang")
            for k, lang in enumerate(languages):
                rows = batch.filter(pa.compute.equal(column, lang))
                size = np.asarray(pa.compute.binary_length(rows.column("word")))
                rows = rows.take(pa.array(np.argsort(-size, kind="stable")))
                size = np.sort(size)[::-1] + 2
                begin = 0
                while begin < rows.num_rows:  # a table of positions per word, as wide as the longest
                    part = rows.slice(begin, max(1, _AREA // int(size[begin])))
                    begin += part.num_rows
                    lattice, order = _lattice(pieces, [b" " + w for w in part.column("word").to_pylist()])
                    total = lattice.expected(chance[:, k:k + 1], part.column("times").to_numpy()[order].astype(float))
                    at = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), k)), pa.array(at), pa.array(total[at])], names=["lang", "piece", "expected"])

    parts = words.select("lang", "word", "times").mapInArrow(step, "lang long, piece long, expected double")
    rows = parts.groupBy("lang", "piece").agg(F.sum("expected").alias("expected")).toPandas()
    counts = np.zeros((_pieces(vocabulary).size, len(languages)))
    counts[rows["piece"], rows["lang"]] = rows["expected"]
    return counts


def _store(spark, chance: np.ndarray) -> str:
    folder = work_folder(spark, "language")
    store, path = open_store(folder)
    store.create_dir(path)
    with store.open_output_stream(f"{path}/chance") as out:
        out.write(np.ascontiguousarray(chance, dtype=np.float64).tobytes())
    return folder


def _load(folder: str, pieces: int) -> np.ndarray:
    store, path = open_store(folder)
    with store.open_input_stream(f"{path}/chance") as source:
        return np.frombuffer(source.read(), dtype=np.float64).reshape(pieces, -1)


def learn(docs: DataFrame, vocabulary: str = VOCABULARY, sample_bytes: int = SAMPLE_BYTES, rounds: int = ROUNDS) -> Model:
    """Fit the piece probabilities of every language in ``docs`` (text, lang). Texts of a language are
    sampled by a hash of the text so that about ``sample_bytes`` bytes of each are expected."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = texts.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = {r["lang"]: min(1.0, sample_bytes / max(r["bytes"], 1)) for r in sizes}
    languages = sorted(share)
    if not languages:
        return Model([], vocabulary, "")
    limit = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(share[lang] * 1_000_000))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    sample = texts.filter(draw < F.try_element_at(limit, F.col("lang"))).withColumn("text", F.lower("text"))
    words = staged(_words_counted(sample), "language-words").repartition(spark.sparkContext.defaultParallelism, "lang", "word")
    k = len(languages)
    chance, folder = None, None
    for _ in range(rounds):
        def model_of(size: int, folder=folder) -> np.ndarray:
            return np.full((size, k), 1.0 / size) if folder is None else _load(folder, size)

        counts = _expected_counts(words, model_of, vocabulary, languages) + SMOOTHING
        chance = counts / counts.sum(axis=0)
        folder = _store(spark, chance)
    return Model(languages, vocabulary, folder)


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model.vocabulary)
        chance = _load(model.folder, pieces.size)
        known_names = np.zeros(0, dtype=np.uint64)
        known = np.zeros((0, len(model.languages)))
        for batch in batches:
            for part in slices(batch, "plain", _SLICE):
                words = words_of(part.column("plain"))
                names, first, which = np.unique(words.names, return_index=True, return_inverse=True)
                values = np.empty((len(names), len(model.languages)))
                at = np.searchsorted(known_names, names)
                at[at == len(known_names)] = 0
                hit = known_names[at] == names if len(known_names) else np.zeros(len(names), dtype=bool)
                values[hit] = known[at[hit]]
                new = np.flatnonzero(~hit)
                step = max(1, _AREA // (LONGEST_PIECE * len(model.languages)))
                for begin in range(0, len(new), step):
                    some = new[begin:begin + step]
                    lattice, order = _lattice(pieces, [b" " + words.text(i) for i in first[some].tolist()])
                    values[some[order]] = lattice.log_chances(chance)
                total = np.zeros((part.num_rows, len(model.languages)))
                text = np.repeat(np.arange(part.num_rows), np.diff(words.first))
                for k in range(total.shape[1]):
                    total[:, k] = np.bincount(text, weights=values[which, k], minlength=part.num_rows)
                best = total.argmax(axis=1)
                weight = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                said = np.asarray(part.column("letters").fill_null(False))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"),
                    pa.array([model.languages[b] if s else "und" for b, s in zip(best.tolist(), said.tolist())], type=pa.string()),
                    pa.array(np.where(said, weight, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])
                if (len(known_names) + len(new)) * len(model.languages) > _CACHED:
                    known_names, known = names, values
                else:
                    both = np.concatenate([known_names, names[new]])
                    order = np.argsort(both)
                    known_names, known = both[order], np.concatenate([known, values[new]])[order]

    return score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out (null without such a column), lang_pred, and score, the
    probability of that language given the text and equal odds before."""
    ship(docs.sparkSession)
    text = F.col("text").cast("string")
    held_out = F.col("held_out") if "held_out" in docs.columns else F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.cast("boolean").alias("held_out"),
                       F.lower(text).alias("plain"), text.rlike(r"\p{L}").alias("letters"))
    if not model.languages:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_scorer(model), "doc_id long, held_out boolean, lang_pred string, score double")


def with_held_out(docs: DataFrame, parts: int = 3, held: int = 1) -> DataFrame:
    """``docs`` (doc_id, text, lang) with held_out: crc32 of the decimal doc_id modulo ``parts`` is ``held``."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select("doc_id", "text", "lang", (number % parts == held).alias("held_out"))
