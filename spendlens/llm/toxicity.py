"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is an embedding of its name plus the embeddings of its character trigrams (bytes,
ASCII letters lower-cased, with the white space around it; their sum over the root of their number).
A forward and a backward gated recurrent layer run over windows of WINDOW words; every text is covered whole by windows that
overlap by WINDOW - STRIDE words. Attention pools the states of a window, a linear layer gives its
logit, and a text's logit is the largest of its windows', calibrated on the training texts with the
weights of all labels. So one toxic passage is found in a text of any length.

Training reads labels of at most SAMPLE texts of each class with SAMPLE_BYTES together, chosen by a hash of
their ids (a text that no longer fits is passed over) among rows that are not held out (crc32 of the id as text, modulo 5, is not 0). In the first steps every
window bears its text's label: what both classes share teaches nothing, what only toxic texts hold
stands out. In the later rounds a text is judged as in use: a toxic one by its most toxic window, a
clean one by the HARDEST of all its windows. Seeds
are fixed, so the same tables give the same scores. Scores use the text alone.

An empty text (null, without words) scores 0. Without labels of both classes every score is the share
of toxic labels. A doubly labelled id counts as toxic if one label is. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .words import LOWER, SPACE, U64, Words, release, slices, words_of

#: Labelled texts that training may read: not toxic, toxic.
SAMPLE = (3000, 1200)
#: Bytes of these texts that the driver may hold: not toxic, toxic.
SAMPLE_BYTES = (12_000_000, 6_000_000)
WINDOW, STRIDE = 32, 16
WORD_BITS, CHAR_BITS = 17, 15
WIDTH, HIDDEN = 8, 8
STEPS, ROUNDS, ROUND_STEPS, HARDEST = 240, 6, 40, 3
BATCH, RATE, DECAY = 512, 0.01, 1e-5
_MULTIPLIER = U64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """Distinct words: the bucket of each name, and the buckets of its trigrams, concatenated."""

    bucket: np.ndarray
    grams: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, words: Words, at: np.ndarray) -> Vocabulary:
        data = np.concatenate([[1], np.where(SPACE[words.data], 1, LOWER[words.data]), [1]]).astype(np.uint64)
        begin, counts = words.start[at], words.end[at] - words.start[at]
        first = np.cumsum(counts) - counts
        place = np.arange(counts.sum()) + np.repeat(begin - first, counts)  # of the byte before, in data
        code = (data[place] << U64(16)) | (data[place + 1] << U64(8)) | data[place + 2]
        return cls((words.names[at] >> U64(64 - WORD_BITS)).astype(np.int32),
                   ((code * _MULTIPLIER) >> U64(64 - CHAR_BITS)).astype(np.int32), counts)

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        first = np.cumsum(self.counts) - self.counts
        chars = np.add.reduceat(p["chars"][self.grams], first, axis=0) if len(self.grams) else np.zeros((0, WIDTH), np.float32)
        return p["words"][self.bucket] + chars / np.sqrt(self.counts[:, None]).astype(np.float32)

    def take(self, which: np.ndarray) -> Vocabulary:
        first = np.cumsum(self.counts) - self.counts
        counts = self.counts[which]
        place = np.arange(counts.sum()) + np.repeat(first[which] - (np.cumsum(counts) - counts), counts)
        return Vocabulary(self.bucket[which], self.grams[place], counts)

    @classmethod
    def joined(cls, parts: list[Vocabulary]) -> Vocabulary:
        return cls(*(np.concatenate([getattr(v, f) for v in parts]) for f in ("bucket", "grams", "counts")))


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word places of every window (-1 beyond the end of its text), and its text. ``first``: where
    the words of each text begin, and where the last ends."""
    sizes = np.diff(first)
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    place = begin[:, None].astype(np.int32) + np.arange(WINDOW, dtype=np.int32)
    beyond = place >= sizes[text][:, None]
    place += first[text][:, None].astype(np.int32)
    place[beyond] = -1
    return place, text


def parameters(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"words": (1 << WORD_BITS, WIDTH), "chars": (1 << CHAR_BITS, WIDTH), "attend": (2 * HIDDEN,),
              "weigh": (2 * HIDDEN,), "bias": (1,)}
    for side in ("f", "b"):
        shapes |= {f"in_{side}": (WIDTH, 3 * HIDDEN), f"add_{side}": (3 * HIDDEN,), f"state_{side}": (HIDDEN, 3 * HIDDEN)}
    scale = {"words": 0.0, "chars": 0.05, "bias": 0.0, "add_f": 0.0, "add_b": 0.0}
    return {k: (rng.standard_normal(s) * scale.get(k, 0.35)).astype(np.float32) for k, s in shapes.items()}


def _recur(ahead: np.ndarray, index: np.ndarray, state: np.ndarray, order: range, tape: list | None) -> np.ndarray:
    """States of one direction for every window: windows x WINDOW x HIDDEN. ``ahead`` holds the
    inputs' part of the gates for each distinct word, its last row that of a missing word."""
    h = np.zeros((len(index), HIDDEN), dtype=np.float32)
    out = np.empty((len(index), WINDOW, HIDDEN), dtype=np.float32)
    for t in order:
        given = ahead[index[:, t]]
        own = h @ state
        gates = np.tanh((given[:, :2 * HIDDEN] + own[:, :2 * HIDDEN]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
        reset, keep = gates[:, :HIDDEN], gates[:, HIDDEN:]
        fresh = np.tanh(given[:, 2 * HIDDEN:] + reset * own[:, 2 * HIDDEN:])
        if tape is not None:
            tape.append((t, h, own[:, 2 * HIDDEN:], reset, keep, fresh))
        h = fresh + keep * (h - fresh)
        out[:, t] = h
    return out


def _pool(p: dict[str, np.ndarray], states: np.ndarray, there: np.ndarray):
    score = np.where(there, states @ p["attend"], np.float32(-1e9))
    weight = np.exp(score - score.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", weight, states)
    return pooled @ p["weigh"] + p["bias"][0], weight, pooled


def logits(p: dict[str, np.ndarray], inputs: np.ndarray, index: np.ndarray, tapes: dict | None = None):
    """The logit of every window; ``index`` into ``inputs``, -1 beyond the text."""
    missing = np.zeros((1, 3 * HIDDEN), dtype=np.float32)
    states = []
    for side, order in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
        ahead = np.concatenate([inputs @ p[f"in_{side}"] + p[f"add_{side}"], missing])
        tape = tapes.setdefault(side, []) if tapes is not None else None
        states.append(_recur(ahead, index, p[f"state_{side}"], order, tape))
    states = np.concatenate(states, axis=2)
    return (*_pool(p, states, index >= 0), states)


def gradients(p: dict[str, np.ndarray], vocabulary: Vocabulary, index: np.ndarray, label: np.ndarray, weight: np.ndarray):
    inputs, tapes = vocabulary.inputs(p), {}
    logit, attention, pooled, states = logits(p, inputs, index, tapes)
    error = ((1 / (1 + np.exp(-logit)) - label) * weight).astype(np.float32)
    g = {"weigh": pooled.T @ error, "bias": np.array([error.sum()], np.float32)}
    to_pool = error[:, None] * p["weigh"]
    along = np.einsum("nh,nth->nt", to_pool, states)
    to_score = attention * (along - (attention * along).sum(axis=1, keepdims=True))
    g["attend"] = np.einsum("nt,nth->h", to_score, states)
    to_states = attention[:, :, None] * to_pool[:, None, :] + to_score[:, :, None] * p["attend"]
    to_inputs = np.zeros_like(inputs)
    missing = len(inputs)
    for i, side in enumerate(("f", "b")):
        state = p[f"state_{side}"]
        to_ahead = np.zeros((missing + 1, 3 * HIDDEN), dtype=np.float32)
        g[f"state_{side}"] = np.zeros_like(state)
        to_h = np.zeros((len(index), HIDDEN), dtype=np.float32)
        for t, h, own, reset, keep, fresh in reversed(tapes[side]):
            to_h = to_h + to_states[:, t, i * HIDDEN:(i + 1) * HIDDEN]
            to_fresh = to_h * (1 - keep) * (1 - fresh * fresh)
            to_keep = to_h * (h - fresh) * keep * (1 - keep)
            to_reset = to_fresh * own * reset * (1 - reset)
            given = np.concatenate([to_reset, to_keep, to_fresh], axis=1)
            back = np.concatenate([to_reset, to_keep, to_fresh * reset], axis=1)
            g[f"state_{side}"] += h.T @ back
            to_h = to_h * keep + back @ state.T
            np.add.at(to_ahead, index[:, t], given)
        to_ahead = to_ahead[:missing]
        g[f"in_{side}"] = inputs.T @ to_ahead
        g[f"add_{side}"] = to_ahead.sum(axis=0)
        to_inputs += to_ahead @ p[f"in_{side}"].T
    g["words"] = _scatter(vocabulary.bucket, to_inputs, 1 << WORD_BITS)
    share = to_inputs / np.sqrt(vocabulary.counts[:, None]).astype(np.float32)
    g["chars"] = _scatter(vocabulary.grams, np.repeat(share, vocabulary.counts, axis=0), 1 << CHAR_BITS)
    return g


def _scatter(place: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(place, weights=rows[:, j], minlength=size) for j in range(rows.shape[1])], axis=1).astype(np.float32)


@dataclass
class Model:
    parameters: dict[str, np.ndarray] = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0
    #: The score of every text if there is nothing to learn from.
    constant: float | None = None

    def window_logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        _, first, back = np.unique(words.names, return_index=True, return_inverse=True)
        place, text = windows(words.first)
        index = np.where(place >= 0, back[place], -1) if len(back) else place
        vocabulary = Vocabulary.of(words, first)
        return logits(self.parameters, vocabulary.inputs(self.parameters), index)[0], text

    def text_logits(self, words: Words) -> np.ndarray:
        """The largest logit of each text's windows; -inf without words."""
        result = np.full(len(words.first) - 1, -np.inf)
        logit, text = self.window_logits(words)
        np.maximum.at(result, text, logit)
        return result

    def scores(self, words: Words) -> np.ndarray:
        if self.constant is not None:
            return np.where(np.diff(words.first) > 0, self.constant, 0.0)
        logit = self.text_logits(words)
        return np.where(np.isfinite(logit), 1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -60, 60))), 0.0)


def _calibrated(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic fit that is best on a grid of slopes and limits."""
    limits = np.unique(np.concatenate([np.quantile(logit[label == v], np.linspace(0, 1, 101)) for v in (0, 1)]))
    limits = np.unique(np.concatenate([limits, (limits[1:] + limits[:-1]) / 2]))
    best = None
    for slope in (0.25, 0.5, 1.0):
        z = np.clip(slope * (logit[None, :] - limits[:, None]), -30, 30)
        loss = (np.log1p(np.exp(np.where(label == 1, -z, z))) * weight).sum(axis=1)
        i = int(loss.argmin())
        if best is None or loss[i] < best[0]:
            best = loss[i], slope, -slope * limits[i]
    return float(best[1]), float(best[2])


def train(texts: list[str], labels: np.ndarray, share: float) -> Model:
    """``share``: of toxic labels among all that may be learned from."""
    names, vocabularies, backs, sizes = [], [], [], []
    for part in slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"]), "text"):
        words = words_of(part.column("text"), lower=True)
        own, at, back = np.unique(words.names, return_index=True, return_inverse=True)
        backs.append((back + sum(map(len, names))).astype(np.int32))
        names.append(own)
        vocabularies.append(Vocabulary.of(words, at))
        sizes.append(np.diff(words.first))
    if not names:
        return Model(constant=share)
    place, text = windows(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]))
    if len(np.unique(labels[text])) < 2:
        return Model(constant=share)
    _, first, among = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    everything = Vocabulary.joined(vocabularies).take(first)
    index = among.astype(np.int32)[np.concatenate(backs)][place]
    index[place < 0] = -1
    del names, vocabularies, backs, place
    rng = np.random.default_rng(5)
    truth = labels[text]
    fitted = np.arange(len(texts)) % 5 != 4  # the others set the limit
    if any(len(np.unique(labels[text[fitted[text] == side]])) < 2 for side in (True, False)):
        fitted[:] = True  # too few texts to set some apart
    ours = fitted[text]
    p = parameters()
    momentum = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    steps = 0

    def chosen(window: np.ndarray) -> tuple[Vocabulary, np.ndarray]:
        """The words of some windows, and the windows' places among them."""
        distinct, inner = np.unique(index[window], return_inverse=True)
        gap = int(distinct[0] == -1)
        return everything.take(distinct[gap:]), inner.reshape(-1, WINDOW) - gap

    def all_logits() -> np.ndarray:
        found = []
        for a in range(0, len(index), 1024):
            own, inner = chosen(np.arange(a, min(a + 1024, len(index))))
            found.append(logits(p, own.inputs(p), inner)[0])
        return np.concatenate(found)

    def steps_on(window: np.ndarray, number: int, toxic_share: float, first_pace: float, last_pace: float) -> None:
        nonlocal steps
        sides = [window[truth[window] == value] for value in (0, 1)]
        sizes = (BATCH - round(toxic_share * BATCH), round(toxic_share * BATCH))
        for i in range(number):
            pick = np.concatenate([rng.choice(side, size) for side, size in zip(sides, sizes)])
            g = gradients(p, *chosen(pick),
                          truth[pick].astype(np.float32), np.full(BATCH, 1 / BATCH, dtype=np.float32))
            steps += 1
            pace = first_pace + (last_pace - first_pace) * i / number
            for k, v in p.items():
                m, s = momentum[k]
                d = g[k] + DECAY * v
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                v -= (pace * (m / (1 - 0.9**steps)) / (np.sqrt(s / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)

    # most windows of toxic texts hold nothing toxic
    steps_on(np.flatnonzero(ours), STEPS, 0.25, RATE, 0.5 * RATE)
    for i in range(ROUNDS):
        order = np.lexsort((-all_logits(), text))
        place_in_text = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        hardest = order[ours[order] & (place_in_text < np.where(truth[order] == 1, 1, HARDEST))]
        steps_on(hardest, ROUND_STEPS, 0.35, 0.5 * RATE * (1 - i / ROUNDS), 0.5 * RATE * (1 - (i + 1) / ROUNDS))
    model = Model(p)
    logit = np.full(len(texts), -np.inf)
    np.maximum.at(logit, text, all_logits())
    there = np.isfinite(logit) & (~fitted | fitted.all())
    y = labels[there].astype(float)
    weight = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    model.slope, model.offset = _calibrated(logit[there], y, weight)
    return model


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    usable = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~_held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(ids, "doc_id", "left_semi"))
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    if len(sizes) < 2:
        return Model(constant=share)
    chosen = [usable.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE[value]) for value in (0, 1)]
    sample = chosen[0].union(chosen[1])  # at most as many ids as SAMPLE says: small enough to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.max(F.octet_length("text")).alias("size"))
    sizes = found.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    ids = [i for value in (0, 1) for i in _within([(r["doc_id"], r["size"]) for r in sizes if r["toxic"] == value], SAMPLE_BYTES[value])]
    limit = F.when(F.col("toxic") == 1, SAMPLE_BYTES[1]).otherwise(SAMPLE_BYTES[0])
    fitting = docs.sparkSession.createDataFrame([(i,) for i in ids], "doc_id long")
    sample = sample.join(F.broadcast(fitting), "doc_id", "left_semi")
    rows = (texts.join(F.broadcast(sample), "doc_id").withColumn("text", F.substring("text", F.lit(1), limit))
            .dropDuplicates(["doc_id"]).collect())
    rows.sort(key=lambda r: r["doc_id"])
    texts, toxic = [r["text"] for r in rows], np.array([r["toxic"] for r in rows])
    del rows
    model = train(texts, toxic, share)
    release()  # the driver lives on through the stages that follow
    return model


def _within(sizes: list[tuple[int, int]], limit: int) -> list[int]:
    """The ids whose texts fit into ``limit`` bytes together: one that no longer fits is passed over. If
    none fits, the shortest (its beginning is used)."""
    ids, left = [], limit
    for i, size in sizes:
        if size <= left:
            ids.append(i)
            left -= size
    return ids or [i for i, _ in sorted(sizes, key=lambda x: x[1])[:1]]


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                scores = model.scores(words_of(part.column("text"), lower=True))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], schema=_SCORED)
        release()

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (score >= 0.5)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed by the bits and widths: under 6 MB
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _score(shared), "doc_id long, score double")
    return scored.select("doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                scores = model.scores(words_of(part.column("text"), lower=True))
                yield part.filter(pa.array(scores < 0.5))
        release()

    return docs.mapInArrow(run, columns)
