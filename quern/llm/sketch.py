"""Threshold-scaled sketches (FracMinHash) as document fingerprints.

A sketch keeps every hash of the text's 5-word shingles that lies in the least
1/``scale`` of all hash values.  The threshold does not depend on the text, so
sketches of very unequal documents can be compared (containment is the share
of one sketch's hashes found in the other), and the sketch of two texts
together is the merge of theirs.  So that short texts are not left without a
hash, a text whose hashes all lie above the threshold keeps its least one;
merging takes the union and drops hashes above the threshold unless no other
is left, so it stays exact.

A shingle's hash is the xxhash64 of its words' xxhash64 values.  A text of
fewer than five words is one shingle; one without words has an empty sketch.
Likeness is the Jaccard estimate of two sketches; two empty ones are alike.
A sketch tells all hashes below the threshold or, when it holds only its least
one, up to that.  Containment is taken over the range both sketches tell and
is null where that range holds none of a's hashes; likeness is the same over
that range as over the sketches, since a lone hash above it is never shared.

The scale sets the error: 16 leaves a text of less than 100 words a handful of
hashes, 2 halves the text's shingles (the query's).

``next_documents`` gives every row the text and sketch of the next document by
ascending id with one shuffle of the texts: rows are grouped by id // 64, at
most 64 ids, and only the last of a group looks up the first of the next group.

Defined results: a null text is an empty one; rows with equal ids follow each
other by text; rows without an id come last, in groups by a hash of the text;
the last row's next is the first row (itself, when alone); an empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, text_of, words
from .ranking import ranked

SHINGLE = 5
SCALE = 16
GROUP = 64


def threshold(scale: int) -> int:
    return min(-(1 << 63) + (1 << 64) // scale, (1 << 63) - 1)


def sketch(text: Column, scale: int = SCALE) -> Column:
    """Ascending array of the kept shingle hashes."""
    def shingles(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) < SHINGLE, F.array(F.xxhash64(h)))
                .otherwise(many))

    def kept(g: Column) -> Column:
        low = F.sort_array(F.array_distinct(F.filter(g, lambda x: x < F.lit(threshold(scale)))))
        return let(low, lambda s: F.when((F.size(s) > 0) | (F.size(g) == 0), s).otherwise(F.array(F.array_min(g))))
    return let(let(F.transform(words(text), lambda w: F.xxhash64(w)), shingles), kept)


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of two texts' shingles together."""
    return let(F.array_union(a, b), lambda u: let(
        F.sort_array(F.filter(u, lambda x: x < F.lit(threshold(scale)))),
        lambda s: F.when((F.size(s) > 0) | (F.size(u) == 0), s).otherwise(F.array(F.array_min(u)))))


def containment(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Estimated share of a's shingles that b has; null where b's sketch does
    not tell (a holds only its least hash, above what b tells of)."""
    told = F.greatest(F.coalesce(F.array_min(b), F.lit((1 << 63) - 1)), F.lit(threshold(scale) - 1))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(let(told, lambda t: let(
        F.filter(a, lambda x: x <= t),
        lambda s: F.when(F.size(s) > 0, F.size(F.array_intersect(s, b)) / F.size(s)))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate."""
    both = F.size(F.array_intersect(a, b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .otherwise(both / (F.size(a) + F.size(b) - both)))


def as_text(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def next_documents(docs: DataFrame, value: Column) -> DataFrame:
    """(doc_id, text, value, next struct(text, value)) of every row."""
    group = F.coalesce(F.floor(F.col("doc_id") / GROUP), F.lit(1 << 61).bitwiseOR(F.xxhash64("text").bitwiseAND(F.lit((1 << 20) - 1))))
    base = (docs.select("doc_id", text_of().alias("text"))
            .select("doc_id", "text", group.cast("long").alias("grp"), value.alias("value")))
    order = Window.partitionBy("grp").orderBy("doc_id", "text")
    # Plain columns in the window functions: an expression would be computed, and
    # carried a second time, below the shuffle.
    rows = base.select("*", F.lead("text").over(order).alias("next_text"), F.lead("value").over(order).alias("next_value"),
                       F.lag("text").over(order).isNull().alias("is_first"))
    place = ranked(docs.select("doc_id", text_of().alias("text")).select(group.cast("long").alias("grp")).distinct(),
                   [], [F.col("grp")], "place")
    count = place.agg(F.max("place")).first()[0] or 0
    after = place.select((F.when(F.col("place") == 1, F.lit(count)).otherwise(F.col("place") - 1)).alias("place"),
                         F.col("grp").alias("next_grp"))
    following = place.join(after, "place").select(F.col("grp").alias("g"), "next_grp")
    # The three readers of ``rows`` share one shuffle of the texts as long as nothing
    # differs below it: grp is never null, so the joins add no filter under it.
    # A lag, not a row number: a group limit before the shuffle would give this branch a shuffle of its own.
    heads = rows.where("is_first").select(F.col("grp").alias("hg"), F.struct("text", "value").alias("head"))
    last = (rows.where(F.col("next_text").isNull()).join(following, F.col("grp") == F.col("g"))
            .join(heads, F.col("next_grp") == F.col("hg")).select("doc_id", "text", "value", F.col("head").alias("next")))
    both = F.struct(F.col("next_text").alias("text"), F.col("next_value").alias("value")).alias("next")
    return rows.where(F.col("next_text").isNotNull()).select("doc_id", "text", "value", both).unionByName(last)


def fingerprint_pairs(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Sketch of each document, of its edited text (the last quarter replaced by
    the next document's beginning), and the likeness to that and to the next."""
    # The sketches are made after the shuffle: of random hashes, they would fill it more than the texts.
    rows = next_documents(docs, F.lit(0))
    n = F.length("text")
    q = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - q), F.substring(F.col("next.text"), F.lit(1), q))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), sketch(F.col("text"), scale).alias("value"),
                       sketch(F.col("next.text"), scale).alias("next_value"), sketch(edited, scale).alias("edited_value"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       as_text(F.col("value")).alias("fingerprint"), as_text(F.col("edited_value")).alias("edited_fingerprint"),
                       likeness(F.col("value"), F.col("edited_value")).alias("near_edited"),
                       likeness(F.col("value"), F.col("next_value")).alias("near_next"))
