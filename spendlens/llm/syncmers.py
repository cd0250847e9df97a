"""Document fingerprints from closed syncmers.

A text's words (runs of characters other than space and \\x09-\\x0D) are hashed; every K consecutive
words are a candidate, and it is an anchor if the smallest hash of the S-word runs inside it is that
of the first or the last. Whether a K-mer is an anchor depends on its own words alone, so equal
passages have equal anchors wherever they stand. The fingerprint is the KEEP anchors with the
smallest hashes, each with the word it stands at: a sample whose choice depends on content alone.

Two fingerprints are compared on the anchors below the bound up to which both are complete. Shared
anchors count if they are displaced like the middle one of all shared anchors, within SLACK words;
the likeness is their share of all anchors there (1 if both texts have none, 0 if one has none).

The edited text of a document has its last floor(n/4) code points replaced by the first as many of
the next document by doc_id (after the last: the first). Neighbours are found on identifiers and
lengths alone, ordered within ranges; then one prefix per document
travels to its predecessor. Rows that repeat a doc_id have the same next document; where the next
one is repeated, the row with the smallest prefix serves. A null doc_id counts as the smallest,
null text as empty; a text of fewer than K words has its whole sequence as the only anchor. Extra
columns are ignored. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import staged

K, S, KEEP, SLACK = 5, 2, 64, 8
_WHITE = r"[\x20\x09-\x0D]+"
_SMALLEST = -(2**63)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column) -> Column:
    """The kept anchors, array<struct<a: hash, p: word>>, in the order of their hashes."""
    inner = K - S + 1

    def with_runs(h: Column, b: Column) -> Column:
        def closed(i: Column) -> Column:
            low = F.least(*[F.get(b, i + j) for j in range(inner)])
            return (low == F.get(b, i)) | (low == F.get(b, i + inner - 1))

        found = F.transform(F.filter(F.sequence(F.lit(0), F.size(h) - K), closed), lambda i: F.struct(
            F.xxhash64(*[F.get(h, i + j) for j in range(K)]).alias("a"), i.alias("p")))
        whole = F.array(F.struct(F.xxhash64(h).alias("a"), F.lit(0).alias("p")))
        return F.array_sort(F.when(F.size(h) >= K, found).when(F.size(h) > 0, whole).otherwise(F.slice(whole, 1, 0)))

    hashes = F.transform(F.filter(F.split(text, _WHITE), lambda x: x != ""), lambda x: F.xxhash64(x))
    order = _let(hashes, lambda h: _let(
        F.zip_with(h, F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))), lambda x, y: F.xxhash64(x, y)),
        lambda b: with_runs(h, b)))
    return _let(order, lambda o: F.slice(F.filter(
        o, lambda x, i: (i == 0) | (x["a"] != F.get(o, F.greatest(i - 1, F.lit(0)))["a"])), 1, KEEP))


def written(kept: str) -> Column:
    """The fingerprint as text: hash and place of each anchor in hexadecimal."""
    return F.concat_ws(" ", F.transform(kept, lambda x: F.concat(F.lower(F.lpad(F.hex(x["a"]), 16, "0")), F.lit("@"),
                                                                 F.lower(F.hex(x["p"])))))


def likeness(one: Column, two: Column) -> Column:
    """The likeness of two fingerprints, 0 to 1."""
    def score(x: Column, y: Column, moved: Column) -> Column:
        shift = F.get(moved, F.floor(F.size(moved) / 2).cast("int"))
        agreed = F.size(F.filter(moved, lambda v: F.abs(v - shift) <= SLACK))
        union = F.size(x) + F.size(y) - F.size(moved)
        return F.when(F.size(moved) == 0, F.lit(0.0)).otherwise((agreed / union).cast("double"))

    def moves(x: Column, y: Column) -> Column:
        places = F.map_from_arrays(F.transform(y, lambda v: v["a"]), F.transform(y, lambda v: v["p"]))
        return _let(places, lambda place: F.array_sort(F.filter(
            F.transform(x, lambda v: F.element_at(place, v["a"]) - v["p"]), lambda v: v.isNotNull())))

    def below(bound: Column) -> Column:
        def part(side: Column) -> Column:
            return F.filter(side, lambda v: v["a"] <= bound)

        return _let(part(one), lambda x: _let(part(two), lambda y: _let(moves(x, y), lambda moved: score(x, y, moved))))

    bound = F.least(*[F.when(F.size(c) < KEEP, F.lit(2**63 - 1)).otherwise(F.element_at(c, -1)["a"]) for c in (one, two)])
    return F.when((F.size(one) == 0) & (F.size(two) == 0), F.lit(1.0)).when(
        (F.size(one) == 0) | (F.size(two) == 0), F.lit(0.0)).otherwise(_let(bound, below))


def neighbours(ids: DataFrame) -> DataFrame:
    """(id, after) for the distinct ids: the next larger one, after the last the first. The order
    is made within ranges of ids, as many as shuffle partitions; a range hands on one row."""
    ranged = staged(ids.select("id").distinct().repartitionByRange("id").withColumn("range", F.spark_partition_id()), "ranges")
    firsts = ranged.groupBy("range").agg(F.min("id").alias("first"))
    everything = Window.orderBy("range")  # a row per shuffle partition
    links = firsts.select("range", F.coalesce(F.lead("first").over(everything), F.first("first").over(
        everything.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("beyond"))
    ordered = ranged.withColumn("after", F.lead("id").over(Window.partitionBy("range").orderBy("id")))
    return ordered.join(links, "range").select("id", F.coalesce("after", "beyond").alias("after"))


def fingerprint_with_edits(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited (likeness to the edited text's), near_next (to the next document's)."""
    # both joins below read the same two columns, so the texts are shuffled once for both
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_SMALLEST)).alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = rows.groupBy("id").agg(F.max(F.expr("char_length(text) div 4")).alias("wanted"))
    asked = (neighbours(sizes).join(sizes, "id")
             .select(F.col("after").alias("id"), F.col("id").alias("before"), "wanted"))
    given = rows.join(asked, "id").select(
        F.col("before").alias("id"), F.struct(F.expr("left(text, int(wanted))").alias("prefix"),
                                              anchors(F.col("text")).alias("kept")).alias("gift"))
    given = given.groupBy("id").agg(F.min("gift").alias("gift"))
    df = rows.join(given, "id").withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited", F.expr("concat(left(text, int(n_chars - n_chars div 4)), left(gift.prefix, int(n_chars div 4)))"))
    df = df.select(F.when(F.col("id") != _SMALLEST, F.col("id")).alias("doc_id"), "n_chars", anchors(F.col("text")).alias("kept"), anchors(F.col("edited")).alias("edited_kept"),
                   F.col("gift.kept").alias("next_kept"), F.sha2("edited", 256).alias("edited_sha256"))
    df = df.withColumns({"near_edited": likeness(F.col("kept"), F.col("edited_kept")),
                         "near_next": likeness(F.col("kept"), F.col("next_kept"))})
    return df.select("doc_id", "n_chars", "edited_sha256", written("kept").alias("fingerprint"),
                     written("edited_kept").alias("edited_fingerprint"), "near_edited", "near_next")
