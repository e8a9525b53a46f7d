"""Mixing sources to target weights by systematic sampling.

Sizes are word counts.  Sources, in code-point order with null last, weigh 3,
1, 2, repeating, and share ``share`` (150 %) of all words; a source stops at
``cap`` (2) times its own words and its excess is shared again by weight until
no source is above.  Inside a source every document has the same expected
copies (target / words of the source); the running sum of those expectations
plus one offset of the source is cut at the whole numbers, and a document is
taken once for every whole number its step crosses, so between floor and
ceiling of its expectation and at most ``cap`` times.

Documents are put in order of size (then of a hash of the id) before the
running sum, which spreads the draws evenly over short and long documents, so
the words taken miss the target by no more than about one document's size.
Running sums are exact: expectation and offset are whole multiples of 2^-24.
The offset comes from the md5 of the source and ``seed``: reruns agree.

Scale: only (id, source, size) leaves the scan.  The running sum is a rank
times a constant, and ranks are range-partitioned by (source, size, hash), so
a source with a third of all rows is cut into as many ranges as it needs.

Defined results: a null text has size 0; a null source is a source of its own;
null ids sort as an empty text; a source without words has target 0 and takes
none; repeated rows are mixed one by one; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.loops import materialize
from .common import text_of, words
from .ranking import ranked

WEIGHTS = (3, 1, 2)
UNIT = 1 << 24


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   cap: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, size) rows."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = ranked(per, [], [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long")
    src = materialize(place.select("source", "source_size", weight.alias("w")))
    limit = F.col("source_size") * cap
    level, capped = 0.0, -1
    while True:  # each round caps more sources or ends; every round is one aggregate
        over = limit < F.lit(level) * F.col("w")
        row = src.agg(F.sum("source_size").alias("total"), F.sum(F.when(over, limit)).alias("used"),
                      F.sum(F.when(~over, F.col("w"))).alias("open"), F.count(F.when(over, 1)).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (share * (row["total"] or 0) - (row["used"] or 0)) / row["open"]
    target = F.least(limit.cast("double"), F.lit(level) * F.col("w"))
    return src.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: int = 2,
        seed: str = "mix-1") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row."""
    sizes = materialize(docs.select("doc_id", "source", F.size(words(text_of())).cast("long").alias("size")))
    targets = source_targets(sizes, weights, share, cap)
    tie = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    t = targets.select("source", "source_size", "target",
                       F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * UNIT))
                       .otherwise(0).cast("long").alias("step"))
    place = ranked(sizes.withColumn("tie", tie), ["source"], [F.col("size"), F.col("tie")], "place", per_key=t)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce("source", F.lit("")))), 1, 6),
                    16, 10).cast("long")
    upto = F.shiftright(F.col("place") * F.col("step") + offset, 24)
    before = F.shiftright((F.col("place") - 1) * F.col("step") + offset, 24)
    out = place.withColumn("copies", (upto - before).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows that agree in id, source and size are interchangeable to the mix:
    the copies of such a group are dealt to its rows as evenly as they came."""
    # The caller's row is one column: its names cannot clash with these.
    keyed = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("i_null"),
                        F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("s_null"),
                        F.size(words(text_of())).cast("long").alias("z"), F.xxhash64("text").alias("th"))
    m = mix(docs, **kw).groupBy(F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("i_null"),
                                F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("s_null"),
                                F.col("size").alias("z")).agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("m"))
    on = ["i", "i_null", "s", "s_null", "z"]
    joined = keyed.join(m, on)
    nth = F.row_number().over(Window.partitionBy(*on).orderBy("th"))
    times = F.floor(F.col("c") / F.col("m")).cast("int") + (nth <= F.col("c") % F.col("m")).cast("int")
    return (joined.withColumn("t", times).where("t > 0")
            .select("row", F.explode(F.array_repeat(F.lit(1), F.col("t")))).select("row.*"))
