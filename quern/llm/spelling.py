"""Spelling variants grouped through a variable-length gram index.

Words are the runs of letters of all texts with their number of occurrences.
Two words are near when one inserted, deleted or replaced code point turns one
into the other.  A word's form is its most frequent near word when that is
``ratio`` times as frequent, and its root is the end of the chain of forms.

Index.  A gram is a beginning or an end of a word.  The gram dictionary counts
them by length class (words of c and c + 1 code points, which are the words
that one edit can turn into each other) and is pruned by frequency, as a trie
is: a gram is only counted where the shorter ones of its word are frequent
(more than ``2 ** frequent`` words).  A word is decomposed into the shortest beginning
and the shortest end that are not frequent: two grams of variable length,
which overlap in words made of frequent parts.

Merging.  An edit affects a gram only if it falls on it.  So for every place of
an edit the number of affected grams is bounded: by 0 or 1 where the place lies
outside a gram, and there the other gram's list finds the near word; by 2 only where the two
grams overlap (or a word has no rare one), and for those places the word is listed by all
of it but that code point, with the places of both parts.  No near word is lost, and a list holds at
most ``2 ** frequent`` words or words that differ in one place, so the pairs
that are compared grow with the words and not with their square.  What is left
is verified by the edit distance.

The dictionary is kept as one bit per slot in 2^21 hashed slots for each gram
length: a fixed size, whatever the vocabulary.  Grams that share a slot only
look more frequent, which makes them longer, never wrong.

Noise: if ``noise`` divides crc32 of ``<doc_id>:<run>``, the run loses the code
point at that hash modulo its length, before anything is counted.

Scale: occurrences are counted per batch before the shuffle by word; the lists
are bounded as above, so no key of the join is hot.

Defined results: a null text has no words; a null id counts as an empty text in
the hash; repeated rows count again; a word without near words keeps itself as
root; ties of the most frequent near word go to the least in code-point order;
an empty table gives an empty result; a run of any length is one word (it is
cut, listed and compared whole); other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.loops import materialize
from ..session import shuffle_partitions
from .common import LOWER

SIZES = (2, 4, 6, 8, 10, 12)  # gram lengths; a word frequent in all of them has no rare gram
FREQUENT = 4  # log2 of the words that a list of one gram holds at most
SLOT_BITS = 21
CELLS = 1 << 20  # code points cut at a time
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def word_counts(docs: DataFrame, min_len: int = 7, noise: int = 31) -> DataFrame:
    """(word, n) of every run of at least ``min_len`` letters, after the noise."""
    # Deletion only shortens: a run below min_len never makes a word.
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_len)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                head = b"%d:" % i if i is not None else b":"
                for run, n in Counter(runs.findall((text or "").translate(LOWER))).items():
                    h = zlib.crc32(head + run.encode())
                    if noise and h % noise == 0:
                        cut = h % len(run)
                        run = run[:cut] + run[cut + 1:]
                        if len(run) < min_len:
                            continue
                    total[run] += n
            if len(total) > 200_000:  # bounded memory; the rest is added after the shuffle
                yield _counted(total)
                total = Counter()
        yield _counted(total)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(count, "word string, n long")
    # Counted per batch already; a set number of partitions, as the gram work on words is more than their bytes tell.
    return rows.repartition(shuffle_partitions(docs.sparkSession), "word").groupBy("word").agg(F.sum("n").alias("n"))


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def _same_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(indexes, code points) of words of one length at a time, about ``CELLS``
    code points at most (or one word)."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lens, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lens[order])) + 1):
        if not len(group):
            continue
        n = int(lens[group[0]])
        step = max(1, CELLS // n)
        for i in range(0, len(group), step):
            own = group[i:i + step]
            yield own, np.array([words[j] for j in own], f"U{n}").view(np.uint32).reshape(len(own), n).astype(np.uint64)


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_BASE, k, 1 << 64))


def _parts(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes of the beginnings and of the ends of 0, 1, .. code points."""
    m, n = points.shape
    begin, end = np.zeros((m, n + 1), np.uint64), np.zeros((m, n + 1), np.uint64)
    for k in range(n):
        begin[:, k + 1] = begin[:, k] * _power(1) + points[:, k]
        end[:, k + 1] = points[:, n - 1 - k] * _power(k) + end[:, k]
    return begin, end


def _mixed(h: np.ndarray, *more: int) -> np.ndarray:
    seed = 0
    for x in more:
        seed = (seed ^ (x + 1)) * 0xD6E8FEB86659FD93 & _MASK
    h = (h ^ np.uint64(seed)) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _grams(parts: tuple[np.ndarray, np.ndarray], c: int, dictionary: list[np.ndarray]):
    """Of the beginning and of the end, in class ``c``: the length of the rare
    gram (0 if the dictionary's levels have none) and a mask of the words
    whose gram of the next length is to be counted."""
    out = []
    for side, h in enumerate(parts):
        size, open_ = np.zeros(len(h), np.int64), np.ones(len(h), bool)
        for q, often in zip(SIZES, dictionary):
            if q > c:
                open_[:] = False
                break
            frequent = often[(_mixed(h[:, q], c, side, q) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
            size[open_ & ~frequent] = q
            open_ &= frequent
        out.append((size, open_))
    return out


def _classes(n: int, min_len: int) -> list[int]:
    """Classes of a word of ``n``: as the shorter and as the longer of a pair."""
    return [c for c in (n, n - 1) if c >= min_len]


def gram_dictionary(words: DataFrame, min_len: int = 7, frequent: int = FREQUENT) -> list[np.ndarray]:
    """For each length of ``SIZES``, the slots of its frequent grams."""
    levels: list[np.ndarray] = []
    for q in SIZES:
        def count(batches, q=q):
            slots = np.zeros(1 << SLOT_BITS, np.int64)
            for b in batches:
                for _, points in _same_length(b.column(0).to_pylist()):
                    parts, n = _parts(points), points.shape[1]
                    for c in _classes(n, min_len):
                        if q <= c:
                            for side, (_, open_) in enumerate(_grams(parts, c, levels)):
                                h = _mixed(parts[side][open_, q], c, side, q)
                                slots += np.bincount((h >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(slots))
            at = np.flatnonzero(slots)
            for i in range(0, len(at), 1 << 18):
                part = at[i:i + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(slots[part])], ["slot", "n"])
        rows = (words.select("word").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
                .where(F.col("n") > (1 << frequent)).select("slot").toPandas())
        often = np.zeros(1 << SLOT_BITS, bool)
        often[rows["slot"].to_numpy(np.int64)] = True
        levels.append(often)
        if not len(rows):
            break
    return levels


def list_keys(points: np.ndarray, c: int, dictionary: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the lists in class ``c`` that words of one length stand in."""
    parts, n = _parts(points), points.shape[1]
    begin, end = parts
    (a, _), (b, _) = _grams(parts, c, dictionary)
    out = []
    for side, size in enumerate((a, b)):
        rows = np.flatnonzero(size)
        out.append((rows, _mixed(parts[side][rows, size[rows]], c, side, 1) ^ _mixed(size[rows].astype(np.uint64), 7)))
    a, b = np.where(a > 0, a, n + 2), np.where(b > 0, b, n + 2)
    # An edit at i leaves i code points before it and c - 1 - i (replaced) or c - i
    # (inserted) behind; it affects both grams if both are longer than that.
    places = range(max(0, c - int(b.max())), min(c + 1, int(a.max())))  # others are in no overlap
    if n == c:
        for i in places[:c - places.start]:
            rows = np.flatnonzero((a > i) & (b > c - 1 - i))
            if len(rows):
                rest = begin[rows, i] * _power(c - 1 - i) + end[rows, c - 1 - i]
                out.append((rows, _mixed(rest, c, 2, i)))
    whole = np.zeros(len(points), bool)
    for i in places:
        both = (a > i) & (b > c - i)
        if n == c:
            whole |= both
        elif both.any():
            rows = np.flatnonzero(both)
            out.append((rows, _mixed(begin[rows, i] * _power(c - i) + end[rows, c - i], c, 3)))
    if whole.any():
        rows = np.flatnonzero(whole)
        out.append((rows, _mixed(begin[rows, c], c, 3)))
    return tuple(np.concatenate(x) for x in zip(*out))


def lists(words: DataFrame, dictionary: list[np.ndarray], min_len: int = 7) -> DataFrame:
    """Entries (key, longer, word) of the inverted lists; ``longer`` marks the
    words of c + 1 code points in class c."""
    def run(batches):
        for b in batches:
            ws = b.column(0).to_pylist()
            for own, points in _same_length(ws):
                word, n = pa.array([ws[j] for j in own], pa.string()), points.shape[1]
                for c in _classes(n, min_len):
                    row, key = list_keys(points, c, dictionary)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(row), n > c)),
                                                      word.take(pa.array(row))], ["key", "longer", "word"])
    return words.select("word").mapInArrow(run, "key long, longer boolean, word string")


def near_pairs(words: DataFrame, min_len: int = 7, frequent: int = FREQUENT) -> DataFrame:
    """(a, b), a the shorter or else the lesser, of the words at distance one."""
    entries = materialize(lists(words, gram_dictionary(words, min_len, frequent), min_len))
    left = entries.where("NOT longer").select(F.col("key").alias("ka"), F.col("word").alias("a"))
    right = entries.select(F.col("key").alias("kb"), "longer", F.col("word").alias("b"))
    met = left.join(right, (F.col("ka") == F.col("kb")) & (F.col("longer") | (F.col("a") < F.col("b")))
                    & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows (word, form) with a form, by pointer doubling.
    A form is at least twice as frequent as its word, so chains have no cycle."""
    state = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        up = state.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        state = materialize(state.join(up, state["root"] == up["_w"], "left")
                            .select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
        if not state.where("moved").limit(1).count():
            return state.select("word", "root")
        state = state.select("word", "root")


def variants(docs: DataFrame, min_len: int = 7, min_count: int = 2, noise: int = 31, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent as its word")
    words = materialize(word_counts(docs, min_len, noise).where(F.col("n") >= min_count))
    pairs = near_pairs(words, min_len)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("nb")), "b")
    best = F.min(F.struct((-F.col("nb")).alias("minus"), F.col("b").alias("word"))).alias("best")
    near = counted.groupBy(F.col("a").alias("_a")).agg(F.count(F.lit(1)).alias("n_near"), best)
    far = -F.col("best.minus") >= F.col("n") * ratio
    rows = materialize(words.join(near, words["word"] == near["_a"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("best.word")).alias("form"),
        F.when(far, -F.col("best.minus")).alias("form_n")))
    chains = roots(rows.where(F.col("form").isNotNull())).select(F.col("word").alias("_w"), "root")
    return rows.join(chains, rows["word"] == chains["_w"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
