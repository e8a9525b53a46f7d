"""Quality rules, lines first.

Every line is judged by three kinds of rules: punctuation (symbol characters
stuck to words, rows of exclamation marks, capitals throughout, the same few
words over and over), navigation (fields between bars or arrows) and
boilerplate (cookie and script notices, filler text).  Failing lines are
removed; a document that loses more than ``max_lost`` of its words with them
is rejected, as is one that fails the document rules (``min_words``, or more
than ``max_repeat`` percent of its words inside 5-word windows that occur
twice).

All of it is column expressions over the row's own text: no shuffle, one scan.
Windows that occur twice are found by sorting the window hashes of a text
(n log n, any length); positions are only sorted for texts with such a window.
Windows are compared by 64-bit hash.

Defined results: a null or empty text has no words, so it fails ``min_words``
and is not kept; blank lines are neither judged nor counted; repeated rows are
judged one by one; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, let, text_of, words

SYMBOLS = "#*$%&|<>"
HAS_WORD = r"[^\x20\x09-\x0D]"
NAVIGATION = r"(\|[^|]*){3}|((^|\s)[»›>](\s)[^»›>]*){3}"
BOILERPLATE = (r"(?i)\b(accept (all )?cookies|we use cookies|cookie policy|enable javascript|javascript is disabled|"
               r"lorem ipsum|skip to (main )?content|back to top|subscribe to our newsletter|"
               r"please sign in|log in to continue)\b")
# Texts without these cannot match the two patterns, which is told faster (the second in lower case).
NAVIGATION_SIGNS = "|»›>"
BOILERPLATE_WORDS = ("cookie", "javascript", "lorem ipsum", "content", "back to top", "newsletter", "please sign in",
                     "log in to continue")
WINDOW = 5


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _any_in(text: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def line_fails(line: Column) -> Column:
    """True when one of the line rules rejects the line."""
    def judge(w: Column) -> Column:
        n = F.size(w)
        symbols = _count_of(line, SYMBOLS + "!{}=_~^\\")
        letters = F.length(F.regexp_replace(line, r"[^\p{L}]", ""))
        capitals = F.length(F.regexp_replace(line, r"[^\p{Lu}]", ""))
        return ((symbols * 10 > F.length(line))
                | ((letters >= 20) & (capitals * 10 > letters * 6))
                | ((n >= 10) & (F.size(F.array_distinct(w)) * 100 < n * 30))
                | (_any_in(line, NAVIGATION_SIGNS) & F.rlike(line, F.lit(NAVIGATION)))
                | let(F.lower(line), lambda x: _any_in(x, BOILERPLATE_WORDS) & F.rlike(line, F.lit(BOILERPLATE))))
    return let(words(line), judge)


def repeated_window_words(w: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more in ``w``."""
    zero = F.lit(0).cast("long")
    hashes = F.transform(w, lambda x: F.xxhash64(x))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            last = F.size(p) - 1
            twice = F.filter(p, lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]))
                             | ((k < last) & (F.get(p, k + 1)["h"] == x["h"])))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def total(s: Column) -> Column:
            n = F.size(s)
            return F.aggregate(F.transform(s, lambda x, k: F.when(k == n - 1, WINDOW).otherwise(
                F.least(F.lit(WINDOW), F.get(s, k + 1) - x))), zero, lambda a, x: a + x)
        return let(let(pairs, places), total)

    def judged(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), zero).otherwise(covered(g))

    return F.when(F.size(w) <= WINDOW, zero).otherwise(let(let(hashes, windows), judged))


def quality(docs: DataFrame, min_words: int = 10, max_repeat: int = 20, max_lost: float = 0.3) -> DataFrame:
    """(doc_id, counts, base_failed, lost_words, cleaned_text, kept) per row."""
    t = docs.select("doc_id", text_of().alias("text"))
    counted = t.select(
        "doc_id", "text",
        let(words(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_window_words(w).alias("n_repeat_words"))).alias("w"),
        let(F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(HAS_WORD))),
            lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.length(F.translate("text", WS, "")).cast("long").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        F.array_join(F.filter(F.split("text", "\n"), lambda x: ~line_fails(x)), "\n").alias("cleaned_text"))
    n, rep = F.col("w.n_words"), F.col("w.n_repeat_words")
    lost = n - F.size(words(F.col("cleaned_text")))
    failed = (n < min_words) | (rep * 100 > n * max_repeat)
    return (counted.select("doc_id", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", rep.alias("n_repeat_words"),
                           failed.alias("base_failed"), lost.cast("long").alias("lost_words"), "cleaned_text")
            .withColumn("kept", ~F.col("base_failed") & (F.col("lost_words") <= F.col("n_words") * max_lost)))
