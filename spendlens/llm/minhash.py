"""Near duplicates by one-permutation hashing.

Every text becomes its set of five-word shingles (ASCII letters lower-cased). One pass over the
set's sorted names gives the smallest name per bin; empty bins borrow from another bin by a fixed
random order per bin, the same for every document (optimal densification). Bands of bins are the
bucket keys. A bucket proposes edges between its members and one centre, its smallest id, and
every edge is confirmed on the full sets.

A bucket whose members are still in several components afterwards may hide a link that its centre
does not have. Its members are compared by signature, in blocks of bounded size and only across
components; pairs that agree on enough bins to be near the limit are confirmed on the full sets
where they are found. A link joins its two components within the block, so a block gives fewer
links than it has components, however many of its pairs are near; members of a bucket's largest
component meet only the others. So every link between two members of a bucket is found or follows
from those given. The chance that a pair at the limit shares no bucket is
``(1 - 0.85 ** ROWS) ** BANDS``, about 1e-9, and that its signatures agree on fewer than ``NEAR``
bins about 1e-10.

Documents with equal sets are one candidate (the smallest id); a text without words (null, empty
or white space) links with nothing. ``doc_id`` is the identifier; rows that repeat one share a
component; a null one is kept and has a null component. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import staged
from .shipping import ship, small_batches
from .words import U64, Words, buffers, join_names, release, scramble, slices, words_of

#: Bytes of text whose sets a task makes at a time.
STEP_BYTES = 1 << 19
SHINGLE = 5
ROWS, BANDS = 8, 64
BINS = ROWS * BANDS
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Equal bins (of BINS) from which a pair is confirmed: the limit less 6.6 deviations.
NEAR = 381
#: Members of a bucket compared at a time, and their shingles.
BLOCK = 512
BLOCK_SHINGLES = 1 << 19
#: Ids up to which the candidates' ids are broadcast (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 2_000_000
_ATTEMPTS = 64
_lenders = np.random.default_rng(7).integers(0, BINS, size=(_ATTEMPTS, BINS))


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, name) of the distinct shingles, sorted by both."""
    names, first = words.names, words.first
    counts = np.diff(first)
    grams = names[:max(0, len(names) - SHINGLE + 1)]
    for j in range(1, SHINGLE):
        grams = join_names(grams, names[j:len(grams) + j])
    document = np.repeat(np.arange(len(counts)), counts)
    whole = document[:len(grams)] == document[SHINGLE - 1:] if len(grams) else np.zeros(0, dtype=bool)
    owner, value = document[:len(grams)][whole], grams[whole]
    for d in np.flatnonzero((counts > 0) & (counts < SHINGLE)):  # the whole sequence is the one shingle
        name = names[first[d]:first[d] + 1]
        for j in range(first[d] + 1, first[d + 1]):
            name = join_names(name, names[j:j + 1])
        owner, value = np.append(owner, d), np.append(value, scramble(name + U64(counts[d])))
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return owner[fresh], value[fresh]


def signatures(owner: np.ndarray, value: np.ndarray, documents: int) -> np.ndarray:
    """Documents x BINS: the smallest name per bin, empty bins filled; a document without shingles
    has zeros."""
    bins = (((value >> U64(32)) * U64(BINS)) >> U64(32)).astype(np.int64)  # rises with the name
    cell = owner * BINS + bins
    fresh = np.ones(len(cell), dtype=bool)
    fresh[1:] = cell[1:] != cell[:-1]
    out = np.zeros(documents * BINS, dtype=np.uint64)
    full = np.zeros(documents * BINS, dtype=bool)
    out[cell[fresh]] = value[fresh]
    full[cell[fresh]] = True
    present = np.zeros(documents, dtype=bool)
    present[owner] = True
    empty = np.flatnonzero(~full & np.repeat(present, BINS))
    for attempt in range(_ATTEMPTS):
        lender = empty - empty % BINS + _lenders[attempt, empty % BINS]
        found = full[lender]
        out[empty[found]] = out[lender[found]]
        empty = empty[~found]
        if not len(empty):
            break
    if len(empty):  # bins that met no full one in all attempts take the smallest name of all
        smallest = np.zeros(documents, dtype=np.uint64)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        smallest[owner[starts]] = value[starts]
        out[empty] = smallest[empty // BINS]
    return out.reshape(documents, BINS)


def band_keys(minima: np.ndarray) -> np.ndarray:
    """Documents x BANDS."""
    rows = minima.reshape(len(minima), BANDS, ROWS)
    key = scramble(rows[:, :, 0] + np.arange(BANDS, dtype=np.uint64))
    for j in range(1, ROWS):
        key = join_names(key, rows[:, :, j])
    return key


_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                     ("bands", pa.list_(pa.int64())), ("bins", pa.binary())])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", STEP_BYTES):
            n = part.num_rows
            owner, value = shingle_sets(words_of(part.column("text"), lower=True))
            minima = signatures(owner, value, n)
            sizes = np.bincount(owner, minlength=n)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            digests = [hashlib.blake2b(value[a:b].tobytes(), digest_size=16).digest() if b > a else None
                       for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()),
                                             pa.array(band_keys(minima).ravel().view(np.int64)))
            low = [row.tobytes() for row in (minima & U64(255)).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 bands, pa.array(low, pa.binary())], schema=_SKETCH)
    release()



def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null without words), bands, low byte of every bin."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sketch, "doc_id long, n_shingles long, digest binary, bands array<long>, bins binary")


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


_SETS = pa.schema([("doc", pa.int64()), ("shingles", pa.binary())])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", STEP_BYTES):
            owner, value = shingle_sets(words_of(part.column("text"), lower=True))
            edges = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
            held = [value[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(held, pa.binary())], schema=_SETS)
    release()


def _compare_blocks(group: pa.Table) -> pa.Table:
    """Links that join different components; ``side`` 0 meets ``side`` 1, and within a block
    everything meets everything. Pairs whose sizes and signatures are near are confirmed on the full
    sets, only in the first bucket that two documents share. Components grow with the links found,
    so of the links between two of them one is given."""
    band = group.column("band")[0].as_py()
    bins = np.frombuffer(b"".join(group.column("bins").to_pylist()), dtype=np.uint8).reshape(-1, BINS)
    keys = group.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    ids, component = group.column("doc").to_numpy(), group.column("component").to_numpy().copy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in group.column("shingles").to_pylist()]
    size = np.array([len(x) for x in sets])
    begin = np.cumsum(size) - size
    distinct, number = np.unique(np.concatenate(sets), return_inverse=True)
    ours = np.zeros(len(distinct), dtype=bool)
    side = group.column("side").to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side != 1 if (side == 0).all() else side == 1)
    found: list[tuple[int, int]] = []
    for i in left.tolist():
        other = right[(component[right] != component[i]) & (ids[right] != ids[i])]
        other = other[100 * np.minimum(size[other], size[i]) >= PERCENT * np.maximum(size[other], size[i])]
        if not len(other):
            continue
        first = (keys[other] == keys[i]).argmax(axis=1)
        other = other[((bins[other] == bins[i]).sum(axis=1) >= NEAR) & (first == band)]
        if not len(other):
            continue
        own = number[begin[i]:begin[i] + size[i]]
        ours[own] = True
        for j in other.tolist():
            if component[j] != component[i]:
                shared = int(np.count_nonzero(ours[number[begin[j]:begin[j] + size[j]]]))
                if 100 * shared >= PERCENT * (int(size[i]) + int(size[j]) - shared):
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    component[component == component[j]] = component[i]
        ours[own] = False
    pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_PAIRS)


def _pair_slices(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive pairs with about ``limit`` bytes in both texts together; a longer pair is alone."""
    total = np.concatenate([[0], np.cumsum(sum(np.diff(buffers(batch.column(c))[1]) for c in ("text_a", "text_b")))])
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + limit, side="right")) - 1)
        yield batch.slice(begin, min(end, batch.num_rows) - begin)
        begin = end


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _pair_slices(batch):
            # the words of one side are gone before the other's are cut
            sides = [shingle_sets(words_of(part.column(c), lower=True)) for c in ("text_a", "text_b")]
            sizes = [np.bincount(owner, minlength=part.num_rows) for owner, _ in sides]
            owner, value = (np.concatenate(x) for x in zip(*sides))
            del sides
            order = np.lexsort((value, owner))
            owner, value = owner[order], value[order]
            shared = np.bincount(owner[1:][(owner[1:] == owner[:-1]) & (value[1:] == value[:-1])],
                                 minlength=part.num_rows)
            linked = 100 * shared >= PERCENT * (sizes[0] + sizes[1] - shared)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], schema=_PAIRS).filter(pa.array(linked))
    release()


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    side = [texts.select(F.col("doc").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
    return pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "text_a", "text_b").mapInArrow(
        _confirm, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc, component) of every document with a link: the smallest id that can be reached. Labels
    pass along links and through the labels themselves, so the rounds grow with the logarithm of a
    chain's length; every round is a table in the shared folder."""
    both = staged(links.select(F.col("a").alias("doc"), F.col("b").alias("other"))
                  .union(links.select(F.col("b"), F.col("a"))), "links")
    label = staged(both.groupBy("doc").agg(F.least(F.min("other"), F.col("doc")).alias("component")), "labels")
    while True:
        around = both.join(label.withColumnRenamed("doc", "other"), "other").groupBy("doc").agg(
            F.min("component").alias("near"))
        of_label = label.select(F.col("doc").alias("component"), F.col("component").alias("root"))
        fresh = staged(
            label.join(around, "doc").join(of_label, "component", "left")
            .select("doc", F.least("component", "near", "root").alias("component"),
                    (F.least("component", "near", "root") != F.col("component")).alias("moved")), "labels")
        label = fresh.select("doc", "component")
        if not fresh.filter("moved").limit(1).count():
            return label


def _links_across(members: DataFrame, label: DataFrame, sketch: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of one bucket that join different components of ``label``."""
    traits = sketch.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), "bands", "bins", "n_shingles").dropDuplicates(["doc"])
    named = members.join(label, "doc", "left").select("bucket", "band", "doc", F.coalesce("component", "doc").alias("component"))
    parts = named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("part"))
    mixed = parts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("part").alias("size"),
        F.max(F.struct("part", "component")).getField("component").alias("main")).filter("parts > 1 AND size > 2")
    opened = staged(named.join(mixed.select("bucket", "main"), "bucket").join(traits.select("doc", "n_shingles"), "doc")
                    .withColumn("main", F.col("component") == F.col("main")), "open")

    def blocks(of_main: bool):
        mine = F.col("main") if of_main else ~F.col("main")
        return F.ceil(F.greatest(F.count_if(mine) / BLOCK, F.sum(F.when(mine, F.col("n_shingles"))) / BLOCK_SHINGLES)).cast("int")

    counts = opened.groupBy("bucket").agg(blocks(False).alias("rest_blocks"), blocks(True).alias("main_blocks"))
    scattered = F.xxhash64("doc")
    sets = texts.join(opened.select("doc").distinct(), "doc", "left_semi").mapInArrow(_sets, "doc long, shingles binary")
    placed = (
        opened.join(counts, "bucket").join(traits.drop("n_shingles"), "doc").join(sets, "doc")
        .withColumn("block", F.when(F.col("main"), F.col("rest_blocks") + F.pmod(scattered, F.col("main_blocks")))
                    .otherwise(F.pmod(scattered, F.col("rest_blocks"))).cast("int"))
        .withColumn("with", F.explode(F.expr(
            "sequence(0, rest_blocks - 1 + IF(main, 0, main_blocks))")))
        .select("bucket", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"),
                F.when(F.col("block") <= F.col("with"), 0).otherwise(1).alias("side"), "band", "doc", "component",
                "bands", "bins", "shingles"))
    return placed.groupBy("bucket", "one", "two").applyInArrow(_compare_blocks, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id that links reach;
    its own without links), kept (doc_id is component_id)."""
    with small_batches(docs.sparkSession):
        sketch = staged(sketches(docs), "sketches")
    groups = staged(sketch.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
                    .agg(F.min("doc_id").alias("doc")), "sets")
    distinct = groups.join(sketch, (groups.digest == sketch.digest) & (groups.doc == sketch.doc_id), "left_semi")
    bands = sketch.join(distinct.select(F.col("doc").alias("doc_id"), F.col("digest")), ["doc_id", "digest"],
                        "left_semi").select(F.col("doc_id").alias("doc"), F.posexplode("bands").alias("band", "bucket"))
    centres = bands.groupBy("bucket").agg(F.min("doc").alias("centre"), F.max("doc").alias("last")).filter("centre < last")
    members = staged(bands.join(centres.select("bucket", "centre"), "bucket").dropDuplicates(["bucket", "doc"]), "buckets")

    active = staged(members.select("doc").distinct(), "active")
    few = active.count() <= BROADCAST_IDS
    chosen = F.broadcast(active) if few else active
    texts = staged(docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
                   .join(chosen, "doc", "left_semi").dropDuplicates(["doc"]), "texts")

    stars = members.filter("doc != centre").select(F.col("centre").alias("a"), F.col("doc").alias("b")).distinct()
    links = staged(_confirmed(stars, texts), "links")
    label = components(links)

    more = staged(_links_across(members, label, sketch, texts), "links")
    if more.limit(1).count():
        label = components(links.union(more))

    own = sketch.select("doc_id", "n_shingles", "digest").join(groups, "digest", "left")
    found = own.join(label, "doc", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose document stands for its group; rows with a null
    doc_id stay."""
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept")).dropDuplicates()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
