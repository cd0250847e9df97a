"""The prefix trie of conversations, in double-array tries per prefix shard.

1. Turns are read in order, one conversation after another, as a stream: each prefix gets a name, the
   digest of its parent's name and the turn. A conversation longer than ``SEGMENT`` turns goes on in
   further segments, so no row grows with it. Equal segments are merged and counted before anything
   else: copies of a conversation cost one row.
2. Segments with the same first turns share a shard, which is chosen by the name of that prefix. It
   begins with ``TOP`` turns; where more than ``LIMIT`` turns lie below one prefix, twice as many turns
   decide, until no prefix is too heavy. Nodes below the deciding prefix lie in one shard only.
3. A shard numbers its distinct turns densely and packs the arrays BASE and CHECK: the child of node s
   by turn t is the cell BASE[s] + t, and CHECK of that cell is s. All segments walk through the arrays
   at once; sums over subtrees go from the deepest cells up.
4. Upper nodes, those that shards share, are merged by name: members, smallest member and what hangs
   below. Their subtree sums are taken in rounds that double the distance to the ancestor they reach,
   so a chain of shared nodes takes the logarithm of its length.

The identifiers of conversations that end at a node are joined in blocks of 4096 and the blocks are
hashed as a stream: a digest of a list has to see the list in order, but never whole.

Rows without conv_id belong to no conversation. Null role or text is empty. Turns come by ``turn``,
null first; rows with an equal turn come by the digest of role and text, repeated rows count each. An
empty table has no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import staged
from .shipping import ship

SEGMENT = 1024
TOP = 2
LIMIT = 20_000
NAME = 16
ROOT = bytes(NAME)
_BLOCK_BITS = 12


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ... in its conversation), turn_key (digest of role and text), words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", F.substring(F.unhex(F.sha2(whole, 256)), 1, NAME).alias("turn_key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "turn_key")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "turn_key", "words")


def with_shared_starts(turns: DataFrame, every: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversation c takes over the first h = crc32(c) mod (``most`` + 1) turns of conversation
    c - c mod ``every`` in place of its own first h. Returns the turns and, per conversation, its
    conv_id and its number of turns, also if it has none left."""
    def start_of(conv: Column) -> Column:
        return conv - F.pmod(conv, F.lit(every))

    h = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    donors = turns.filter((F.pmod("conv_id", F.lit(every)) == 0) & (F.col("place") <= most))
    donated = donors.groupBy(F.col("conv_id").alias("start")).agg(F.count(F.lit(1)).alias("donated"))
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    members = sizes.withColumns({"h": h, "start": start_of(F.col("conv_id"))}).join(donated, "start", "left").select(
        "conv_id", "start", "h", F.least(F.col("h"), F.coalesce("donated", F.lit(0))).alias("taken"), "size")
    members = staged(members, "members")
    borrowed = members.filter("taken > 0").select("conv_id", "start", "taken").join(
        donors.withColumnRenamed("conv_id", "start"), "start").filter("place <= taken").select(*turns.columns)
    own = turns.join(members.select("conv_id", "h", "taken"), "conv_id").filter("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "turn_key", "words")
    length = F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))
    return own.union(borrowed), members.select("conv_id", length.alias("length"))


_NAMES = pa.list_(pa.binary())
_SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("start_depth", pa.int64()), ("start", pa.binary()), ("nodes", _NAMES), ("turn_keys", _NAMES),
    ("words", pa.list_(pa.int64())), ("goes_on", pa.bool_())])


def _cutter(segment: int):
    """Cuts turns, sorted by conversation and place, into segments with the names of their prefixes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, start, node = None, 0, ROOT, ROOT
        nodes, keys, words, done = [], [], [], []

        def close(goes_on: bool) -> None:
            nonlocal nodes, keys, words
            if nodes:
                done.append((conv, depth, start, nodes, keys, words, goes_on))
            nodes, keys, words = [], [], []

        def written() -> pa.RecordBatch:
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*done), _SEGMENTS)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_SEGMENTS)

        for batch in batches:
            for c, key, count in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn_key", "words"))):
                if c != conv:
                    close(False)
                    conv, depth, start, node = c, 0, ROOT, ROOT
                elif len(nodes) == segment:
                    close(True)
                    depth, start = depth + segment, node
                node = hashlib.blake2b(node + key, digest_size=NAME).digest()
                nodes.append(node)
                keys.append(key)
                words.append(count)
            if done:
                yield written()
        close(False)
        if done:
            yield written()

    return cut


def segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per segment of a conversation; ``goes_on`` unless it is the last."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select(
        "conv_id", "turn_key", "words").mapInArrow(
        _cutter(segment), "conv_id long, start_depth long, start binary, nodes array<binary>, turn_keys array<binary>, "
                          "words array<long>, goes_on boolean")


class DoubleArray:
    """A trie over label sequences in the arrays ``base`` and ``check``. Node 0 is the root.

    Sequence i is ``labels[at[i]:at[i] + size[i]]``; sequences come longest first. Labels are dense
    and are numbered anew in the order in which the trie meets them, so children of a node mostly have
    neighbouring numbers and need few free cells. ``levels[d]`` are the cells of depth d + 1,
    ``trace[d]`` those that the sequences of more than d labels reach."""

    def __init__(self, labels: np.ndarray, at: np.ndarray, size: np.ndarray):
        self.number = np.full(labels.max(initial=-1) + 1, -1, dtype=np.int64)
        cells = max(64, 2 * len(labels))
        self.base, self.check = np.zeros(cells, dtype=np.int64), np.full(cells, -1, dtype=np.int64)
        self.check[0] = 0
        self.top = 1  # all cells from here on are free
        self.levels, self.trace = [], []
        state, met, width = np.zeros(len(size), dtype=np.int64), 0, len(self.number) + 1
        for depth in range(int(size.max(initial=0))):
            active = np.searchsorted(-size, -depth, side="left")
            label = labels[at[:active] + depth]
            known = self.number[label]
            fresh = np.unique(np.stack([state[:active][known < 0], label[known < 0]]), axis=1)[1]
            _, first = np.unique(fresh, return_index=True)
            fresh = fresh[np.sort(first)]
            self.number[fresh] = np.arange(met, met + len(fresh))
            met += len(fresh)
            edges = np.unique(state[:active] * width + self.number[label])
            self._place(edges // width, edges % width)
            state[:active] = self.base[state[:active]] + self.number[label]
            self.levels.append(self.base[edges // width] + edges % width)
            self.trace.append(state[:active].copy())

    def _grow(self, cells: int) -> None:
        if cells > len(self.check):
            extra = max(cells, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(extra, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(extra, -1, dtype=np.int64)])

    def _place(self, parent: np.ndarray, number: np.ndarray) -> None:
        """Find cells for the children of nodes of one level; edges come sorted."""
        begin = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        count = np.diff(np.append(begin, len(parent)))
        for i in np.flatnonzero(count > 1).tolist():
            children = number[begin[i]:begin[i] + count[i]]
            reach = children - children[0]
            self._grow(self.top + 32 + int(reach[-1]) + 1)
            free = np.flatnonzero(self.check[:self.top] < 0)[:16].tolist()
            cell = next((c for c in free if (self.check[c + reach] < 0).all()), self.top)
            self.base[parent[begin[i]]] = cell - children[0]
            self.check[cell + reach] = parent[begin[i]]
            self.top = max(self.top, cell + int(reach[-1]) + 1)
        single = begin[count == 1]
        self._grow(self.top + len(single) + 1)
        free = np.flatnonzero(self.check < 0)[:len(single)]
        self.base[parent[single]] = free - number[single]
        self.check[free] = parent[single]
        self.top = max(self.top, int(free.max(initial=0)) + 1)

    def find(self, labels: list[int]) -> int:
        """The cell that a sequence leads to, -1 if the trie has no such path."""
        state = 0
        for label in labels:
            number = self.number[label] if 0 <= label < len(self.number) else -1
            cell = self.base[state] + number
            if number < 0 or not 0 < cell < len(self.check) or self.check[cell] != state:
                return -1
            state = int(cell)
        return state


_NODES = pa.schema([
    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("words", pa.int64()), ("upper", pa.bool_())])
_FAR = np.iinfo(np.int64).max


def _fixed(names: pa.Array) -> np.ndarray:
    return np.array(names.to_pylist(), dtype=f"S{NAME}")


def _nodes_of_shard(shard: pa.Table) -> pa.Table:
    """The nodes of a shard. Of an upper node, what this shard knows: members, and the children and
    subtree sums of those children that lie in this shard only."""
    shard = shard.combine_chunks()
    size = np.asarray(shard.column("nodes").combine_chunks().value_lengths(), dtype=np.int64)
    shard = shard.take(pa.array(np.argsort(-size, kind="stable")))
    flat = {c: shard.column(c).combine_chunks().flatten() for c in ("nodes", "turn_keys", "words")}
    column = {c: shard.column(c).to_numpy() for c in ("start_depth", "copies", "conv_id", "cut", "goes_on")}
    size = np.sort(size)[::-1]
    n, first = len(size), np.concatenate([[0], np.cumsum(size)])[:-1]
    starts, start_label = np.unique(_fixed(shard.column("start")), return_inverse=True)
    _, turn_label = np.unique(_fixed(flat["turn_keys"]), return_inverse=True)
    # a path is the node where its segment begins, as a label of its own, and the turns of the segment
    labels = np.empty(len(turn_label) + n, dtype=np.int64)
    at = first + np.arange(n)
    is_turn = np.ones(len(labels), dtype=bool)
    is_turn[at] = False
    labels[at], labels[is_turn] = start_label, turn_label + len(starts)
    trie = DoubleArray(labels, at, size + 1)

    cells = len(trie.check)
    members, low, depth = np.zeros(cells, dtype=np.int64), np.full(cells, _FAR), np.zeros(cells, dtype=np.int64)
    words, source = np.zeros(cells, dtype=np.int64), np.full(cells, -1, dtype=np.int64)
    upper = np.zeros(cells, dtype=bool)
    own_words = np.asarray(flat["words"])
    for d, reached in enumerate(trie.trace):
        rows = slice(0, len(reached))
        depth[reached] = column["start_depth"][rows] + d
        upper[reached[(column["cut"][rows] > d) | column["goes_on"][rows].astype(bool)]] = True
        if d:  # where a segment begins, the one before it has counted
            np.add.at(members, reached, column["copies"][rows])
            np.minimum.at(low, reached, column["conv_id"][rows])
            source[reached] = first[rows] + d - 1
            words[reached] = own_words[first[rows] + d - 1]
    used = np.concatenate(trie.levels)
    children = np.bincount(trie.check[used], minlength=cells)
    leaves = np.where(children == 0, 1, 0)
    saved = np.where(upper, 0, (members - 1) * words)
    children, leaves = (np.where(upper, 0, x) for x in (children, leaves))
    for reached in reversed(trie.levels[1:]):
        below = reached[~upper[reached]]
        parent = trie.check[below]
        np.add.at(leaves, parent, leaves[below])
        np.add.at(saved, parent, saved[below])
        np.add.at(children, parent[upper[parent]], 1)

    names = _fixed(flat["nodes"])
    name = np.zeros(cells, dtype=f"S{NAME}")
    name[used] = names[source[used]]
    begins = trie.levels[0]
    for path, label in zip(trie.trace[0].tolist(), start_label.tolist()):
        name[path] = starts[label]
    inner = np.ones(cells, dtype=bool)
    inner[begins] = False

    def binary(values: np.ndarray, known: np.ndarray) -> pa.Array:
        return pa.array([v.ljust(NAME, b"\0") if k else None for v, k in zip(values.tolist(), known.tolist())], type=pa.binary())

    def numbers(values: np.ndarray, known: np.ndarray) -> pa.Array:
        return pa.array(values, mask=~known)

    parent, all_known = trie.check[used], np.ones(len(used), dtype=bool)
    return pa.Table.from_arrays([
        binary(name[used], all_known), binary(name[parent], inner[used]), pa.array(depth[used]),
        numbers(low[used], inner[used]), numbers(low[parent], inner[used] & ~upper[parent]), pa.array(members[used]),
        pa.array(children[used]), pa.array(leaves[used]), pa.array(saved[used]),
        numbers(words[used], inner[used]), pa.array(upper[used])], schema=_NODES)


def _sharded(distinct: DataFrame, limit: int) -> DataFrame:
    """Every distinct segment with ``cut``, the number of turns that decide its shard, and ``shard``."""
    prefix = F.element_at("nodes", F.least(F.col("cut"), F.size("nodes")).cast("int"))
    rows = distinct.withColumn("cut", F.lit(TOP).cast("long"))
    while True:
        below = rows.groupBy(prefix.alias("prefix")).agg(
            F.sum(F.size("nodes")).alias("turns"), F.max(F.size("nodes") > F.col("cut")).alias("deeper"))
        heavy = staged(below.filter(F.col("turns") > limit).filter("deeper").select("prefix"), "heavy")
        if not heavy.limit(1).count():
            break
        marked = rows.withColumn("prefix", prefix).join(heavy.withColumn("heavy", F.lit(True)), "prefix", "left")
        rows = staged(marked.withColumn("cut", F.when(F.col("heavy"), F.col("cut") * 2).otherwise(F.col("cut")))
                      .drop("prefix", "heavy"), "segments")
    total = rows.agg(F.sum(F.size("nodes").cast("long"))).first()[0] or 0
    return rows.withColumn("shard", F.pmod(F.xxhash64(prefix), F.lit(max(1, -(-total // limit)))))


def _subtree_sums(upper: DataFrame) -> DataFrame:
    """node, n_leaves, saved_tokens of upper nodes over all that lies below them. After a round a node
    holds the sums of its descendants nearer than ``reach``; adding what the nodes at that distance
    hold doubles it."""
    sums = upper.select("node", F.col("parent").alias("above"), "n_leaves", "saved_tokens")
    deepest = upper.agg(F.max("depth")).first()[0] or 0
    reach = 1
    while reach <= deepest:
        brought = sums.filter("above IS NOT NULL").groupBy(F.col("above").alias("node")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        further = sums.filter("above IS NOT NULL").select(F.col("node").alias("above"), F.col("above").alias("next"))
        sums = staged(sums.join(brought, "node", "left").join(further, "above", "left").select(
            "node", F.col("next").alias("above"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens")), "sums")
        reach *= 2
    return sums.drop("above")


def _digest_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, digest = None, None

    def result(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), schema)], schema=schema)

    for batch in batches:
        done = []
        for name, block in zip(batch.column("node").to_pylist(), batch.column("block").to_pylist()):
            if name != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = name, hashlib.sha256(block.encode())
            else:
                digest.update(b"," + block.encode())
        if done:
            yield result(done)
    if node is not None:
        yield result([(node, digest.hexdigest())])


def _ends(ending: DataFrame) -> DataFrame:
    """node, digest of the ascending identifiers (conv_id) of the conversations that end there."""
    blocks = ending.groupBy("node", F.shiftright("conv_id", _BLOCK_BITS).alias("number")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("block"))
    return blocks.repartition("node").sortWithinPartitions("node", "number").select("node", "block").mapInArrow(
        _digest_blocks, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, limit: int = LIMIT, segment: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, place, turn_key, words): node (its name),
    parent, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``members`` holds the conversations (conv_id, length), those without
    turns too. ``limit``: turns that a shard is meant to hold; ``segment``: turns in one row at most."""
    ship(turns.sparkSession)
    pieces = staged(segments(turns, segment), "segments")
    distinct = staged(
        pieces.groupBy(F.element_at("nodes", -1).alias("end")).agg(
            F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("conv_id"), F.max("goes_on").alias("goes_on"),
            F.first(F.struct("start_depth", "start", "nodes", "turn_keys", "words")).alias("path"))
        .select("copies", "conv_id", "goes_on", "path.*"), "distinct")
    parts = staged(_sharded(distinct, limit).groupBy("shard").applyInArrow(
        _nodes_of_shard, "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
                         "n_children long, n_leaves long, saved_tokens long, words long, upper boolean"), "nodes")

    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens", "words")], F.lit(True).alias("upper"))
    merged = parts.filter("upper").union(root).groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("words").alias("words"))
    merged = staged(merged, "upper")
    inner = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("upper_children"))
    children = F.col("n_children") + F.coalesce("upper_children", F.lit(0))
    upper = staged(merged.join(inner, "node", "left").select(
        "node", "parent", "depth", "conv_id", "n_convs", children.alias("n_children"),
        (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "upper")
    sums = _subtree_sums(upper)

    shape = ["node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    lower = parts.filter("NOT upper")
    below_upper = upper.drop("n_leaves", "saved_tokens").join(sums, "node").select(*shape).union(
        lower.filter("parent_conv_id IS NULL").select(*shape))
    above = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = below_upper.join(above, "parent", "left").select(*shape, "parent_conv_id").union(
        lower.filter("parent_conv_id IS NOT NULL").select(*shape, "parent_conv_id"))
    ending = pieces.filter("NOT goes_on").select(F.element_at("nodes", -1).alias("node"), "conv_id").union(
        members.filter("length = 0").select(F.lit(ROOT), "conv_id"))
    return nodes.join(_ends(ending), "node", "left").select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
