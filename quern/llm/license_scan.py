"""License scans: exact set-similarity join of text blocks with license templates.

Base: places where a phrase's words stand one after another.  The method adds
labels: a block gets a template's label when it holds at least ``threshold``
of the template's distinct words.  A block is a line, or the words around the
end of a line: its last and the next following words (of as many lines as that
takes), each as many as the longest template has, so that a wrapped notice
stands in one block.  Lines without words are passed over.  Across a line end
the template's beginning is looked for before it and its rest after it, so that
words of a neighbouring line do not complete another notice.  A template with a
license's name in it (``NAMES``) also needs the block to hold that name.

1. Words of the templates are counted over the whole corpus and put in one
   global order, rarest first (a table of template words, a parameter's size).
2. Prefix filter: a block that holds ``need = ceil(threshold * |T|)`` words of a
   template must hold one of its first ``|T| - need + 1`` words in that order.
   Documents without any such word are left after one pass.
3. Blocks are equi-joined with the templates on prefix words; length filter:
   the block has at least ``need`` distinct words; positional filter: the words
   of template and block from the first shared prefix word on still suffice.
4. The surviving pairs are verified on the whole word sets.

Defined results: a null or empty text has no words, no places (first_word and
last_word null), empty labels and score 0; repeated rows each get their
result; other columns are not read; no templates or phrases give no labels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, literal_table, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # letters of either case are words here

PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "this work is licensed under the gnu general public license version"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("reserved", "all rights reserved no part may be reproduced without permission"),
]
NAMES = {"apache", "mit", "bsd"}


def word_count(pieces: Column) -> Column:
    """Words among the pieces of a split (its first and last may be empty)."""
    n = F.size(pieces)
    return n - (F.get(pieces, F.lit(0)) == "").cast("int") - ((n > 1) & (F.get(pieces, n - 1) == "")).cast("int")


def exact_words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), lambda w: w != "")


def corpus_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest word first by its count in the whole corpus."""
    found = (docs.select(F.explode(F.split(F.lower(text_of()), SEPARATORS)).alias("w")).where(F.col("w").isin(vocabulary))
             .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())  # at most one row per vocabulary word
    n = {r["w"]: r["n"] for r in found}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def _phrase_places(w: Column, phrase: str) -> Column:
    parts = phrase.split()
    def at(i: Column) -> Column:
        same = F.get(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            same = same & (F.get(w, i + k) == p)
        return same
    return F.when(F.size(w) >= len(parts), F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), at)).otherwise(
        F.array().cast("array<int>"))


def wrapped(text: Column, longest: int, ordered: Column, prefix: Column) -> Column:
    """Per line end with a prefix word around it: the words of ``ordered`` among
    the last ``longest`` words of the line (before), as many following it (after)
    and both (known)."""
    def around(lines: Column) -> Column:
        heads = F.transform(lines, lambda w: F.slice(w, 1, longest))
        def block(i: Column, h: Column) -> Column:
            w = F.get(lines, i)
            tail = F.slice(w, F.greatest(F.size(w) - longest + 1, F.lit(1)), F.lit(longest))
            after = F.slice(F.flatten(F.slice(h, i + 2, F.lit(longest))), 1, longest)
            return F.struct(F.array_intersect(ordered, tail).alias("before"), F.array_intersect(ordered, after).alias("after"),
                            F.array_intersect(ordered, F.concat(tail, after)).alias("known"))
        known = let(heads, lambda h: F.transform(F.sequence(F.lit(0), F.size(lines) - 2), lambda i: block(i, h)))
        return F.when(F.size(lines) > 1, F.filter(known, lambda k: F.arrays_overlap(k["known"], prefix)))
    return let(F.filter(F.transform(F.split(text, "\n"), exact_words), lambda w: F.size(w) > 0), around)


def block_matches(docs: DataFrame, templates, order: list[str], threshold: float) -> DataFrame:
    """(doc_id, th, block, label, held): blocks that meet a template's threshold."""
    rank = {w: i for i, w in enumerate(order)}
    rows, prefix_words = [], set()
    for number, (label, body) in enumerate(templates):
        t = sorted(set(body.split()), key=rank.get)
        need = math.ceil(threshold * len(t) - 1e-9)
        for i, w in enumerate(t[: len(t) - need + 1]):
            rows.append((number, label, w, i, need, " ".join(t), body, next((n for n in t if n in NAMES), None)))
            prefix_words.add(w)
    spark: SparkSession = docs.sparkSession
    table = (literal_table(spark, rows, [("number", "int"), ("label", "string"), ("word", "string"), ("i", "int"), ("need", "int"), ("sorted", "string"), ("body", "string"), ("name", "string")])
             .withColumns({"t": F.split("sorted", " "), "body": F.split("body", r"\s+")}).drop("sorted"))
    prefix = F.array(*[F.lit(w) for w in sorted(prefix_words)])
    hit = docs.where(F.arrays_overlap(F.split(F.lower("text"), SEPARATORS), prefix))
    ordered = F.array(*[F.lit(w) for w in order])
    lines = (hit.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("block", "line"))
             .where(F.arrays_overlap(F.split(F.lower("line"), SEPARATORS), prefix))
             .select("doc_id", "th", "block", F.array_distinct(exact_words(F.col("line"))).alias("words"))
             .select("doc_id", "th", "block", F.size("words").alias("n"), F.array_intersect(ordered, F.col("words")).alias("known"))
             .withColumns({"before": F.col("known"), "after": F.col("known")}))
    longest = max(len(body.split()) for _, body in templates)
    # Blocks across line ends are numbered -1, -2, ...; only their template words leave the row.
    across = (hit.where(F.instr("text", "\n") > 0)
              .select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(wrapped(F.col("text"), longest, ordered, prefix)).alias("at", "around"))
              .select("doc_id", "th", (-1 - F.col("at")).alias("block"), F.size("around.known").alias("n"), "around.known", "around.before", "around.after"))
    blocks = lines.unionByName(across)
    meets = blocks.select("*", F.explode(F.array_intersect(F.col("known"), prefix)).alias("w")).join(table, F.col("w") == F.col("word"))
    left = F.least(F.size("t") - F.col("i"), F.size("known") - F.array_position("known", F.col("word")).cast("int") + 1)
    named = F.col("name").isNull() | F.array_contains("known", F.col("name"))
    pairs = meets.where((F.col("n") >= F.col("need")) & (left >= F.col("need")) & named)
    # The template is cut at every word: its first part before the line end, the rest after it (for a line, both are the line).
    def parts(c: Column) -> Column:
        first = F.array_intersect(F.slice("body", F.lit(1), c), F.col("before"))
        rest = F.array_intersect(F.slice("body", c + 1, F.size("body")), F.col("after"))
        return F.when(F.size(first) > 0, F.size(F.array_union(first, rest))).otherwise(0)
    held = F.array_max(F.transform(F.sequence(F.lit(1), F.size("body")), parts))
    return (pairs.select("doc_id", "th", "block", "number", "label", "need", F.size("t").alias("size"), held.alias("held"))
            .where(F.col("held") >= F.col("need")).select("doc_id", "th", "block", "number", "label", (F.col("held") / F.col("size")).alias("held"))
            .distinct())


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: words, places of the phrases, labels, score."""
    vocabulary = sorted({w for body, _ in phrases for w in body.split()} | {w for _, body in templates for w in body.split()})
    docs = docs.select("doc_id", text_of().alias("text"))
    order = corpus_order(docs, vocabulary) if vocabulary else []
    rank = {w: i for i, w in enumerate(order)}
    rarest = [min(p.split(), key=rank.get) for p, _ in phrases]
    none = F.array().cast("array<int>")
    counted = docs.select(
        "doc_id", "text", F.xxhash64("text").alias("th"),
        let(F.split(F.lower("text"), SEPARATORS), lambda a: F.struct(
            word_count(a).cast("long").alias("n_words"),
            F.arrays_overlap(a, F.array(*[F.lit(w) for w in rarest]) if rarest else F.array(F.lit(None).cast("string"))).alias("maybe"))).alias("c"))
    places = F.when(F.col("c.maybe"), let(exact_words(F.col("text")), lambda w: F.array(*[_phrase_places(w, p) for p, _ in phrases]))
                    ) if phrases else F.lit(None).cast("array<array<int>>")
    rows = counted.select("doc_id", "th", F.col("c.n_words").alias("n_words"), F.coalesce(places, F.array(none)).alias("places"))
    flat = F.flatten("places")
    names = F.array(*[F.lit(label) for _, label in phrases]) if phrases else F.array().cast("array<string>")
    found = F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda x, k: F.when(F.size(F.get("places", k)) > 0, x)),
                                                   lambda x: x.isNotNull())))
    rows = rows.select("doc_id", "th", "n_words", F.size(flat).cast("long").alias("n_base"),
                       F.array_min(flat).cast("long").alias("first_word"), F.array_max(flat).cast("long").alias("last_word"),
                       found.alias("base"))
    if templates:
        more = (block_matches(docs, templates, order, threshold).groupBy(F.col("doc_id").alias("d"), F.col("th").alias("t"))
                .agg(F.collect_set("label").alias("more"), F.max("held").alias("held")))
        rows = rows.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")
    else:
        rows = rows.withColumn("more", F.lit(None).cast("array<string>")).withColumn("held", F.lit(None).cast("double"))
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.greatest(F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)), F.coalesce("held", F.lit(0.0)))
    return rows.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                       F.array_join(labels, ",").alias("labels"), score.alias("score"))
