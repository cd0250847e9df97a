"""Vector bin packing of documents into training sequences.

A piece of a document is a vector: tokens, segments (one a piece) and loss-bearing tokens. A
sequence holds at most ``Limits`` of each. Every task packs its own partition without a shuffle:

* a document as long as a sequence or longer gives whole sequences of its own, as far as the loss
  limit lets it; the rest is an item;
* one sequence is open at a time; of up to ``POOL`` waiting items the one with the largest dot
  product of its vector and the room that is left (each divided by its limit) is placed, among
  those that fit whole;
* if none fits, the one with the largest dot product is cut so that it fills the sequence; its rest
  waits on;
* what is left at the end of a partition, less than a sequence, is cut into sequences whose lengths
  are powers of two, which need no padding.

So padding is at most what the segment or loss limit leaves of a sequence, and there is none where
they do not bind. Sequence ids are a task's number times 2**33 plus a running number. The result
depends on the partitions of the input, not on the attempt.

Null text counts as empty: a document of no ids but the closing one. ``loss_share`` may name a
column with the share of a document's tokens that bear loss (null: 1).
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segments import tokenizer
from .shipping import ship
from .words import LOWER, buffers, gather, scramble, slices, word_ranges

POOL = 256
#: Signs that never join a letter before them: ASCII punctuation but for "'" (as in 's) and "<|>" of special tokens.
_IS_MARK = np.isin(np.arange(256), list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"))
_IS_LOWER = np.isin(np.arange(256), np.arange(97, 123))
_IS_LETTER = _IS_LOWER | np.isin(np.arange(256), np.arange(65, 91))
#: First bytes of UTF-8 that begin no letter of Latin-1, and "<".
_IS_ODD = np.isin(np.arange(256), [ord("<"), *range(0xC0, 0xC3), *range(0xC4, 256)])
#: Second bytes after 0xC3: the signs of multiplication and division, and capital letters.
_IS_SIGN = np.isin(np.arange(256), [0x97, 0xB7])
_IS_CAPITAL = np.isin(np.arange(256), np.arange(0x80, 0x9F)) & ~_IS_SIGN
#: Masks of the first so many of eight bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Words of letters per call of the tokenizer, which spends more on a call than on a word.
GROUP = 512
#: Bytes of text that are worked on at a time, so that their arrays stay near the core.
SLICE = 512 << 10


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


class _Column:
    """An array that grows at its end."""

    def __init__(self, dtype: type, size: int = 0):
        self.room, self.size = np.zeros(max(size, 1024), dtype), size

    @property
    def held(self) -> np.ndarray:
        return self.room[:self.size]

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.room):
            room = np.empty(max(end, 2 * len(self.room)), self.room.dtype)
            room[:self.size] = self.held
            self.room = room
        self.room[self.size:end] = values
        self.size = end


def _hash(keys: np.ndarray) -> np.ndarray:
    return scramble(keys[0] + keys[1] * np.uint64(0x9E3779B97F4A7C15) + keys[2] * np.uint64(0xD1342543DE82EF95))


class _Words:
    """Ids of words in one growing array; the tokenizer is asked once per stem.

    Marks after a letter are pre-tokens of their own and the tokenizer folds case, so words share
    the ids of their stem, in lower case unless it holds "<", where a special token may begin, or
    characters beyond the letters of Latin-1, which may compose with others before case is folded.
    Stems and marks of up to ``SHORT`` bytes are looked up by those bytes in a table with open
    addressing, all of a slice at once; longer ones in a dictionary."""

    LIMIT = 1_200_000
    SHORT = 23

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = tokenizer(vocabulary)
        #: The same model for words of lower-case Latin-1 letters, which neither normalizer nor pre-tokenizer changes.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(names.values()) + 1, dtype=bool)  # ids that end a pre-token
        self.closes[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.flat, self.begin = _Column(np.int32), _Column(np.int64, 2)  # piece 0: nothing
        self.keys = [_Column(np.uint64, 1) for _ in range(3)]  # bytes of the pieces and their number; 0 for long ones
        self.slots = np.zeros(1 << 16, np.int32)  # pieces by the hash of their keys; 0: free
        self.long: dict[bytes, int] = {}

    def _new_pieces(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Encode stems; the numbers of their pieces."""
        at = np.cumsum(size + 1) - size - 1
        spaced = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
        spaced[gather(at, size)] = data[gather(start, size)]
        simple, wide = _IS_LOWER[spaced], np.flatnonzero(spaced >= 128)
        simple[wide] = (spaced[wide] == 0xC3) | ((spaced[wide - 1] == 0xC3) & ~_IS_SIGN[spaced[wide]])
        simple[at + size] = True
        plain = np.logical_and.reduceat(simple, at)
        order, ids, sizes, others = [], [], [], []
        for made, members in ((self.plain, np.flatnonzero(plain)), (self.tokenizer, np.flatnonzero(~plain))):
            texts = spaced[gather(at[members], size[members] + 1)].tobytes().decode().split(" ")[:-1]
            words = list(zip(members.tolist(), texts))
            if made is not self.plain:
                others += [w for w in words if not w[1].isalpha()]
                words = [w for w in words if w[1].isalpha()]
            groups = [words[i:i + GROUP] for i in range(0, len(words), GROUP)]
            joined = [" ".join([t for _, t in g]) for g in groups]
            for group, together in zip(groups, made.encode_batch_fast(joined, add_special_tokens=False) if joined else []):
                own = np.array(together.ids, dtype=np.int32)
                ends = np.flatnonzero(self.closes[own])
                if len(ends) == len(group):  # one pre-token a word; otherwise a letter folds into more
                    order += [i for i, _ in group]
                    ids.append(own)
                    sizes.append(np.diff(ends, prepend=-1))
                else:
                    others += group
        encoded = self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False) if others else []
        lists = [e.ids for e in encoded]
        ids.append(np.fromiter(chain.from_iterable(lists), dtype=np.int32))
        sizes.append(np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))
        placed = np.array(order + [i for i, _ in others], dtype=np.int64)
        number = np.empty(len(size), dtype=np.int32)
        number[placed] = np.arange(len(size)) + (self.begin.size - 1)
        self.flat.add(np.concatenate(ids))
        self.begin.add(self.begin.held[-1] + np.cumsum(np.concatenate(sizes)))
        for column, key in zip(self.keys, keys):
            column.add(key[placed])
        return number

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (_hash(keys) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _differ(self, piece: np.ndarray, keys: np.ndarray) -> np.ndarray:
        first, second, third = (column.held[piece] != key for column, key in zip(self.keys, keys))
        return first | second | third

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Pieces by their keys; 0 where there is none."""
        at = self._slot(keys)
        piece = self.slots[at]
        other = np.flatnonzero((piece > 0) & self._differ(piece, keys))
        while len(other):
            at[other] = (at[other] + 1) & (len(self.slots) - 1)
            found = piece[other] = self.slots[at[other]]
            other = other[(found > 0) & self._differ(found, keys[:, other])]
        return piece

    def _keep(self, piece: np.ndarray) -> None:
        """Give pieces with keys their slots; the table stays at most half full."""
        if 2 * self.begin.size > len(self.slots):
            self.slots = np.zeros(1 << (2 * self.begin.size).bit_length(), np.int32)
            piece = np.flatnonzero(self.keys[2].held).astype(np.int32)
        at = self._slot(np.stack([column.held[piece] for column in self.keys]))
        while len(piece):
            free = self.slots[at] == 0
            self.slots[at[free]] = piece[free]  # one of those that want it
            left = self.slots[at] != piece
            at, piece = (at[left] + 1) & (len(self.slots) - 1), piece[left]

    def _pieces(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Pieces of the ranges ``data[start:start + size]``, none of them empty; SHORT + 1 bytes follow the last."""
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        keys = np.zeros((3, len(start)), dtype=np.uint64)
        keys[0] = eight[start] & _FIRST[np.minimum(size, 8)]
        more = np.flatnonzero(size > 8)
        keys[1, more] = eight[start[more] + 8] & _FIRST[np.minimum(size[more] - 8, 8)]
        more = more[size[more] > 16]
        keys[2, more] = eight[start[more] + 16] & _FIRST[np.minimum(size[more] - 16, 7)]
        keys[2] |= np.minimum(size, 255).astype(np.uint64) << np.uint64(56)
        piece = self._find(keys)
        new = np.flatnonzero((piece == 0) & (size <= self.SHORT))
        if len(new):
            new = new[np.argsort(_hash(keys[:, new]))]  # equal keys side by side
            first = np.ones(len(new), dtype=bool)
            first[1:] = (keys[:, new[1:]] != keys[:, new[:-1]]).any(axis=0)
            chosen = new[first]
            own = self._new_pieces(data, start[chosen], size[chosen], keys[:, chosen])
            self._keep(own)
            piece[new] = own[np.cumsum(first) - 1]
        long = np.flatnonzero(size > self.SHORT)
        if len(long):
            texts = [data[a:a + n].tobytes() for a, n in zip(start[long].tolist(), size[long].tolist())]
            unknown = {t: i for t, i in zip(texts, long.tolist()) if t not in self.long}
            if unknown:
                chosen = np.array(list(unknown.values()))
                own = self._new_pieces(data, start[chosen], size[chosen], np.zeros((3, len(chosen)), dtype=np.uint64))
                self.long.update(zip(unknown, own.tolist()))
            piece[long] = [self.long[t] for t in texts]
        return piece

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's begin. White space separates pre-tokens and
        is dropped, and no rule of the tokenizer looks across it, so words are encoded alone."""
        if self.begin.size > self.LIMIT or self.flat.size > 8 * self.LIMIT:
            self.reset()
        data, edges = buffers(column)
        data, edges = data[edges[0]:edges[-1]], edges - edges[0]
        start, end, first = word_ranges(data, edges)
        last, open_ = end - 1, np.flatnonzero(_IS_MARK[data[end - 1]])  # last: before the marks
        while len(open_):
            last[open_] -= 1
            open_ = open_[last[open_] >= start[open_]]
            open_ = open_[_IS_MARK[data[last[open_]]]]
        marked = np.flatnonzero((last < end - 1) & (last >= start))
        sign = data[last[marked]]
        marked = marked[_IS_LETTER[sign] | ((data[last[marked] - 1] == 0xC3) & ~_IS_SIGN[sign])]
        stem_end = end.copy()
        stem_end[marked] = last[marked] + 1

        folded = np.zeros(len(data) + self.SHORT + 1, dtype=np.uint8)
        folded[:len(data)] = LOWER[data]
        latin = np.flatnonzero(data == 0xC3)
        second = folded[latin + 1]
        folded[latin[_IS_CAPITAL[second]] + 1] += 32
        odd = np.concatenate([latin[_IS_SIGN[second]], np.flatnonzero(_IS_ODD[data])])
        if len(odd):
            whole = np.zeros(len(start), dtype=bool)
            whole[np.searchsorted(start, odd, side="right") - 1] = True
            places = gather(start[whole], (end - start)[whole])
            folded[places] = data[places]

        place = np.zeros(len(start) + 1, dtype=np.int64)  # of stems, if marks follow theirs
        place[marked + 1] = 1
        place = np.cumsum(place) + np.arange(len(place))
        found = self._pieces(folded, np.concatenate([start, stem_end[marked]]), np.concatenate([stem_end - start, (end - stem_end)[marked]]))
        pieces = np.empty(len(found), dtype=np.int32)
        pieces[place[:-1]] = found[:len(start)]
        pieces[place[marked] + 1] = found[len(start):]
        begin = self.begin.held[pieces]
        sizes = self.begin.held[pieces + 1] - begin
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat.held[gather(begin, sizes)], total[place[first]]


class Packer:
    """Places items (document, start, tokens, loss-bearing tokens) and gives placed pieces
    (document, start, tokens, sequence, offset)."""

    def __init__(self, limits: Limits, first: int):
        self.limits, self.next = limits, first
        self.scale = 1.0 / np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        self.wait: deque[tuple[int, int, int, int]] = deque()
        self.waiting = 0  # tokens of the items in ``wait``
        self.placed: list[tuple[int, int, int, int, int]] = []
        self.room = [0, 0, 0]
        self._open()

    def _open(self) -> None:
        self.sequence, self.next = self.next, self.next + 1
        self.room = [self.limits.tokens, self.limits.segments, self.limits.loss]

    def _place(self, document: int, start: int, tokens: int, loss: int) -> None:
        self.placed.append((document, start, tokens, self.sequence, self.limits.tokens - self.room[0]))
        self.room[0] -= tokens
        self.room[1] -= 1
        self.room[2] -= loss

    @staticmethod
    def _cut(item: tuple[int, int, int, int], tokens: int, loss: int) -> tuple[tuple, tuple]:
        document, start, size, bearing = item
        return (document, start, tokens, loss), (document, start + tokens, size - tokens, bearing - loss)

    def _fill(self) -> None:
        """Place from the waiting items until the open sequence is full."""
        vectors = np.array([(t, 1, b) for _, _, t, b in self.wait], dtype=float)
        gone = np.zeros(len(vectors), dtype=bool)
        items = list(self.wait)
        while not gone.all() and self.room[0] > 0 and self.room[1] > 0:
            room = np.array(self.room, dtype=float)
            worth = (vectors * self.scale) @ (room * self.scale)
            fits = (vectors[:, 0] <= room[0]) & (vectors[:, 2] <= room[2]) & ~gone  # a piece is one segment
            if fits.any():
                best = int(np.argmax(np.where(fits, worth, -1.0)))
                self._place(*items[best])
                gone[best] = True
                continue
            best = int(np.argmax(np.where(gone, -1.0, worth)))
            _, _, tokens, loss = items[best]
            part = min(tokens, self.room[0])
            if -(-loss * part // tokens) > self.room[2]:  # the loss limit binds first
                part = tokens * self.room[2] // loss
            bearing = -(-loss * part // tokens)
            if part <= 0:
                break
            head, items[best] = self._cut(items[best], part, bearing)
            vectors[best] = (items[best][2], 1, items[best][3])
            gone[best] = not items[best][2]
            self._place(*head)
        self.wait = deque(x for x, g in zip(items, gone.tolist()) if not g)
        self.waiting = sum([x[2] for x in self.wait])
        self._open()

    def add(self, document: int, tokens: int, loss: int) -> None:
        item, whole = (document, 0, tokens, loss), self.limits.tokens
        while item[2] >= whole and -(-item[3] * whole // item[2]) <= self.limits.loss and self.room[0] == whole:
            head, item = self._cut(item, whole, -(-item[3] * whole // item[2]))
            self._place(*head)
            self._open()
        if item[2]:
            self.wait.append(item)
            self.waiting += item[2]
        while len(self.wait) >= POOL or self.waiting >= POOL * whole:
            self._fill()

    def finish(self) -> None:
        while self.wait and (self.waiting >= self.limits.tokens or len(self.wait) > self.limits.segments):
            self._fill()
        left = self.waiting
        while left:  # the rest of the partition: lengths that are powers of two
            room = 1 << (left.bit_length() - 1)
            self.room = [room, self.limits.segments, self.limits.loss]
            used = 0
            while used < room and self.room[1] > 0:
                document, start, tokens, loss = self.wait.popleft()
                part = min(tokens, room - used)
                bearing = -(-loss * part // tokens)
                if bearing > self.room[2]:
                    if self.room[2] < self.limits.loss:  # the next sequence has room for it
                        self.wait.appendleft((document, start, tokens, loss))
                        break
                    part = max(1, tokens * self.room[2] // loss)
                    bearing = -(-loss * part // tokens)
                self.placed.append((document, start, part, self.sequence, used))
                self.room[1] -= 1
                self.room[2] -= bearing
                used += part
                if part < tokens:
                    self.wait.appendleft((document, start + part, tokens - part, loss - bearing))
            left -= used
            self.sequence, self.next = self.next, self.next + 1


_words: dict[str, _Words] = {}

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                     ("ids", pa.list_(pa.int32()))])


def _pack(vocabulary: str, closing: int, limits: Limits, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words.get(vocabulary) or _words.setdefault(vocabulary, _Words(vocabulary))
        context = TaskContext.get()
        packer = Packer(limits, (context.partitionId() if context else 0) << 33)
        held: dict[int, tuple[int | None, np.ndarray]] = {}  # ids of documents not placed to the end
        placed_tokens: dict[int, int] = {}
        number = 0

        def pieces() -> pa.RecordBatch:
            columns: list[list] = [[] for _ in _PIECES]
            for document, start, tokens, sequence, offset in packer.placed:
                doc_id, ids = held[document]
                own = ids[start:start + tokens].astype("<u4")
                row = (doc_id, start, tokens, zlib.crc32(own.tobytes()), len(ids), sequence, offset,
                       own.astype(np.int32) if with_ids else None)
                for column, value in zip(columns, row):
                    column.append(value)
                placed_tokens[document] = placed_tokens.get(document, 0) + tokens
                if placed_tokens[document] == len(ids):
                    del held[document], placed_tokens[document]
            packer.placed.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                flat, first = words.encode(part.column("text"))
                shares = part.column("share").to_pylist()
                for i, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    ids = np.append(flat[first[i]:first[i + 1]], closing).astype(np.uint32)
                    share = 1.0 if shares[i] is None else min(max(shares[i], 0.0), 1.0)
                    held[number] = (doc_id, ids)
                    packer.add(number, len(ids), round(len(ids) * share))
                    number += 1
                if packer.placed:
                    yield pieces()
        packer.finish()
        yield pieces()

    return run


def pack(docs: DataFrame, vocabulary: str, closing: int, limits: Limits = Limits(), loss_share: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), length, ids_crc32, doc_tokens
    (with the closing id), sequence_id, offset; with ``with_ids`` the ids."""
    ship(docs.sparkSession)
    share = F.col(loss_share).cast("double") if loss_share else F.lit(None).cast("double")
    pieces = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), share.alias("share")).mapInArrow(
        _pack(vocabulary, closing, limits, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>")
    return pieces if with_ids else pieces.drop("ids")
