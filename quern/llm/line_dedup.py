"""Line dedup by winnowing: repeated runs of lines of ``min_words`` or more
words are deleted, save for their first occurrence.

1. Every non-blank line of a document (blanks at its ends cut) becomes a
   64-bit hash with its word count.
2. Winnowing, measured in words: a gram starts at a line and takes lines until
   it has ``min_words / 2`` words; a window is the grams that start within the
   next ``min_words / 2`` words; the least gram hash of each window is a
   fingerprint.  Any run of ``min_words`` words or more holds a whole window,
   so both copies of it select the same gram: every repeated run is met.
3. Each fingerprint is joined with its first place in the corpus (in order of
   document id and line), one row per occurrence, never occurrence with
   occurrence.
4. From the joined places the match is extended both ways, line by line, over
   at most ``min_words`` lines each way.  Within a run the selected grams lie
   closer than that, so neighbouring extensions meet and together give the
   maximal run, while one row stays small whatever the documents' lengths.
5. A place whose lines differ from the first place's within ``min_words`` words
   of the gram may repeat another place instead.  Such a place names the least
   runs of ``min_words`` words that hold its gram by a hash of their lines, and
   these are joined with their own first place among the places of this kind.
   Each fingerprint's places that agree with its first place all round need no
   second look, nor does a fingerprint with two places.
6. Runs with ``min_words`` words or more are deleted from the later document.
   Every deleted line has an equal line at an earlier place, so the first
   occurrence of any line stays.

Together the lines deleted are those of every run of ``min_words`` words or more
that also stands at an earlier place: each line of such a run lies in a least
run inside it, which holds a fingerprint of both places.

Texts are read twice (to hash lines, to delete them); all joins between are on
lines' hashes.  Line hashes are cut into overlapping blocks, so a document of
any length is joined by its block.

Defined results: a null text stays null, an empty or blank one stays as it is;
rows with null ids come last in the order; rows equal in id and text are
treated alike (both keep the first occurrence, both lose a later one); an
empty table gives an empty one; columns besides doc_id and text are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.loops import materialize
from .common import WS, let, words

BLOCK = 64
_KEY = ["doc_id", "th"]


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, th, raw[], h[], w[]): number, hash and words of each line with a
    word; one row per distinct (doc_id, text)."""
    cut = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("raw"), F.btrim(x, F.lit(WS)).alias("line")))
    seq = let(F.filter(cut, lambda x: x["line"] != ""), lambda a: F.struct(
        F.transform(a, lambda x: x["raw"]).alias("raw"), F.transform(a, lambda x: F.xxhash64(x["line"])).alias("h"),
        F.transform(a, lambda x: F.size(words(x["line"]))).alias("w")))
    return (docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("th"), seq.alias("s"))
            .select(*_KEY, "s.raw", "s.h", "s.w").where(F.size("h") > 0).dropDuplicates(_KEY))


def fingerprints(seqs: DataFrame, gram_words: int) -> DataFrame:
    """(doc_id, th, pos, gram): the window minima of each document."""
    lines = seqs.select(*_KEY, F.posexplode(F.arrays_zip("h", "w"))).select(*_KEY, F.col("pos"), "col.h", "col.w")
    by_pos = Window.partitionBy(*_KEY).orderBy("pos")
    at = F.coalesce(F.sum("w").over(by_pos.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    lines = lines.withColumn("at", at)
    ahead = Window.partitionBy(*_KEY).orderBy("at").rangeBetween(0, gram_words - 1)
    lines = lines.withColumn("gram", F.when(F.sum("w").over(ahead) >= gram_words, F.xxhash64(F.collect_list("h").over(ahead))))
    least = F.min(F.when(F.col("gram").isNotNull(), F.struct("gram", (-F.col("pos")).alias("back")))).over(ahead)
    return (lines.select(*_KEY, least.alias("m")).where(F.col("m").isNotNull())
            .groupBy(*_KEY, F.col("m.gram").alias("gram"), (-F.col("m.back")).alias("pos")).agg(F.lit(1).alias("one")).drop("one"))


def _blocks(seqs: DataFrame, reach: int) -> DataFrame:
    """Line hashes in blocks of ``BLOCK`` lines with ``reach`` more each side;
    ``lo`` is the place of a block's first entry."""
    lo = F.greatest(F.lit(0), F.col("blk") * BLOCK - reach)
    n = (F.col("blk") + 1) * BLOCK + reach - F.col("lo")
    return (seqs.select(*_KEY, "raw", "h", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("h") - 1) / BLOCK).cast("int"))).alias("blk"))
            .withColumn("lo", lo).withColumn("n", n)
            .select(*_KEY, "blk", "lo", *[F.slice(c, F.col("lo") + 1, F.col("n")).alias(c) for c in ("raw", "h", "w")]))


def _agree(top: Column, differs) -> Column:
    """Steps 0, 1, ... that agree before the first that differs, at most ``top``."""
    bad = F.filter(F.sequence(F.lit(0), top - 1), differs)
    return F.when(top < 1, F.lit(0)).otherwise(F.coalesce(F.array_min(bad), top))


def _least_runs(at: Column, min_words: int) -> Column:
    """The least runs of ``min_words`` words around the line ``ib`` of a block, as
    array of (key, at, raw): those that start there or before, shortest from each
    first line, and the shortest to each last line that none of these ends with."""
    lo = F.greatest(F.lit(0), F.col("ib") - min_words)
    r = F.col("ib") - lo

    def runs(p: Column) -> Column:  # p: words before each line of the stretch
        last = F.size(p) - 1
        ahead = F.transform(F.filter(F.sequence(F.lit(0), r), lambda s: F.get(p, r) - F.get(p, s) < min_words),
                            lambda s: F.struct(s.alias("s"), F.size(F.filter(p, lambda x: x < F.get(p, s) + min_words)).alias("e")))
        to = F.transform(F.sequence(r + 1, last), lambda e: F.struct(
            (F.size(F.filter(p, lambda x: x <= F.get(p, e) - min_words)) - 1).alias("s"), e.alias("e")))
        long = F.filter(to, lambda x: (x["s"] >= 0) & (x["s"] <= r) & (F.get(p, x["e"] - 1) - F.get(p, x["s"]) >= min_words))
        return F.concat(F.filter(ahead, lambda x: x["e"] <= last), long)

    stretch = F.slice("b_w", lo + 1, r + min_words)
    before = F.aggregate(stretch, F.array(F.lit(0)), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
    return F.transform(let(before, runs), lambda x: F.struct(
        F.xxhash64(F.slice("b_h", lo + x["s"] + 1, x["e"] - x["s"])).alias("key"), (at + lo + x["s"]).alias("at"),
        F.slice("b_raw", lo + x["s"] + 1, x["e"] - x["s"]).alias("raw")))


def repeated_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(doc_id, th, gone): numbers of the lines to delete, per document."""
    seqs = materialize(line_hashes(docs))
    marks = materialize(fingerprints(seqs, min_words // 2))
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("th"), F.col("pos"))
    first = (marks.groupBy(F.col("gram").alias("g")).agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("times"))
             .where("times > 1").select("g", F.col("f.doc_id").alias("fd"), F.col("f.th").alias("ft"), F.col("f.pos").alias("fp"),
                                        (F.col("times") > 2).alias("others")))
    met = (marks.join(first, F.col("gram") == F.col("g"))
           .where(~(F.col("doc_id").eqNullSafe(F.col("fd")) & (F.col("th") == F.col("ft")) & (F.col("pos") == F.col("fp"))))
           .select(*_KEY, "pos", "fd", "ft", "fp", "others"))
    blocks = _blocks(seqs, min_words)
    here = blocks.select(*[F.col(c).alias(f"b_{c}") for c in blocks.columns])
    there = blocks.select(*[F.col(c).alias(f"a_{c}") for c in blocks.columns if c not in ("raw", "w")])
    pairs = (met.join(here, F.col("doc_id").eqNullSafe(F.col("b_doc_id")) & (F.col("th") == F.col("b_th"))
                      & (F.floor(F.col("pos") / BLOCK) == F.col("b_blk")))
             .join(there, F.col("fd").eqNullSafe(F.col("a_doc_id")) & (F.col("ft") == F.col("a_th"))
                   & (F.floor(F.col("fp") / BLOCK) == F.col("a_blk"))))
    pairs = pairs.withColumn("ib", F.col("pos") - F.col("b_lo")).withColumn("ia", F.col("fp") - F.col("a_lo"))
    back = _agree(F.least("ib", "ia", F.lit(min_words)),
                  lambda d: F.get("b_h", F.col("ib") - 1 - d) != F.get("a_h", F.col("ia") - 1 - d))
    ahead = _agree(F.least(F.size("b_h") - F.col("ib"), F.size("a_h") - F.col("ia"), F.lit(min_words)),
                   lambda d: F.get("b_h", F.col("ib") + d) != F.get("a_h", F.col("ia") + d))
    runs = pairs.withColumn("back", back.cast("int")).withColumn("ahead", ahead.cast("int"))
    start, n = F.col("ib") - F.col("back") + 1, F.col("back") + F.col("ahead")
    total = lambda first, count: F.aggregate(F.slice("b_w", first, count), F.lit(0), lambda a, x: a + x)
    # All round: as far as the document goes, or far enough for every least run that holds the gram.
    all_back = (F.col("back") == F.least("ib", F.lit(min_words))) | (total(start, F.col("back")) >= min_words)
    all_ahead = ((F.col("ahead") == F.least(F.size("b_h") - F.col("ib"), F.lit(min_words)))
                 | (total(F.col("ib") + 2, F.greatest(F.col("ahead") - 1, F.lit(0))) >= min_words))
    looked = materialize(runs.select(
        *_KEY, F.when(total(start, n) >= min_words, F.slice("b_raw", start, n)).alias("found"),
        F.when(F.col("others") & ~(all_back & all_ahead), _least_runs(F.col("b_lo"), min_words)).alias("tries"))
        .where("found IS NOT NULL OR size(tries) > 0"))
    tries = looked.select(*_KEY, F.explode("tries").alias("t")).select(*_KEY, "t.key", "t.at", "t.raw")
    at = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("th"), F.col("at"))
    # A plain table: the places of a run that stands everywhere can then be split in the join.
    earliest = materialize(tries.groupBy(F.col("key").alias("k")).agg(F.min(at).alias("f"), F.max(at).alias("to"))
                           .where(F.col("f") != F.col("to")).select("k", "f"))
    later = (tries.join(earliest, F.col("key") == F.col("k"))
             .where(~(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("th") == F.col("f.th")) & (F.col("at") == F.col("f.at")))))
    return (looked.select(*_KEY, F.explode("found").alias("raw")).unionByName(later.select(*_KEY, F.explode("raw").alias("raw")))
            .distinct().groupBy(*_KEY).agg(F.collect_list("raw").alias("gone")))


def dedup_lines(docs: DataFrame, min_words: int = 50, info: str | None = "_dedup") -> DataFrame:
    """``docs`` with ``text`` freed of later repeated runs, and n_lines and
    n_removed (long) in the struct column ``info`` (none for None).  Other
    columns may have any names but that one."""
    if info in docs.columns:
        raise ValueError(f"the table has a column {info} already")
    gone = repeated_lines(docs, min_words).select(F.col("doc_id").alias("of"), "th", "gone")
    # The caller's row is one column: its names cannot clash with these.
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("row_th"))
    joined = rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("row_th") == F.col("th")), "left")
    lines = F.split("row.text", "\n")
    left = let(lines, lambda a: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(a) - 1), F.col("gone")), lambda i: F.get(a, i)), "\n"))
    counts = F.struct(F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                      F.greatest(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left)
    return joined.select(*[text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns],
                         *([counts.alias(info)] if info else []))
