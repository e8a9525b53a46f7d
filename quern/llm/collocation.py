"""Phrase collocations by dynamic itemset counting.

Texts are cut into pieces at punctuation and line ends and pieces into words.
A phrase is a run of words inside a piece; ``f`` counts all its occurrences.
Everything is counted per language.

Counting.  Documents are dealt once to ``shards``, which are scanned in a cycle.
A step scans one shard and counts phrases of all lengths at a time.  Single words
are counted from the first step on; a longer phrase is activated as soon as
both phrases that it becomes without its first or its last word have reached
``min_count`` in what was scanned so far, and is then counted for one full
cycle: every shard once, so its count is exact.  A phrase with enough occurrences
is always activated, at the latest when its parts have completed their cycle.
A phrase that completes its cycle below the threshold is dropped.  The scans
end when no phrase is active.

What has reached the threshold is known to the tasks as one bit per slot of
2^23 hashed slots for each length and step: a fixed size, whatever the corpus.  Phrases
that share a slot are activated together, which can only activate more phrases
or activate them earlier: a phrase is still counted in the whole cycle that
follows its activation, by its words and not by its hash.

Scores.  A candidate is cut after each of its words; the cut's score is
floor(10^6 a a / (l r)) with the counts of both parts, computed in 38-digit
integers, and the lowest cut counts.  A candidate inside a longer one with at
least ``cover`` percent of its occurrences is dropped.

Scale: a task counts about ``CHUNK`` bytes of a language at a time before the
shuffle by (language, phrase), so a common word is one row of each chunk.  Joins
with the counts of parts split the parts that many candidates share
(``spread_join``).  Ranks come from the best rows of each of many parts of a
language, so no task orders a whole language.

Defined results: a null text has no words; a null language is ``und``; the id is not
read, so null ids and repeated rows count like others; a language without candidates has
no rows; an empty table gives an empty result; long texts are counted whole, in
chunks that hold at least one text; ties are ordered by the phrase's bytes.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.loops import discard, materialize, scratch_folder, union_all
from ..session import shuffle_partitions
from .common import spread_join

SHARDS = 2
SLOT_BITS = 23
PAGE = 4096  # bytes of slots that are set in one task
CHUNK = 6 << 20  # bytes of text
_STOP = b"\xff"  # in no UTF-8 text
_CUT = re.compile(rb"[.,;:!?\n-\r]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC4CEB9FE1A85EC53)


def _next_hash(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    out = (h * _MUL + word) * _MIX
    return out ^ (out >> np.uint64(31))


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


class Reached:
    """Bits of the phrases of one length that have reached the threshold."""

    def __init__(self, bits: bytes | None = None):
        self.bits = bits or bytes(1 << (SLOT_BITS - 3))

    def with_slots(self, pages: dict[int, bytes]) -> Reached:
        bits = bytearray(self.bits)
        whole = np.frombuffer(bits, np.uint8)
        for page, more in pages.items():
            whole[page * PAGE:(page + 1) * PAGE] |= np.frombuffer(more, np.uint8)
        return Reached(bytes(bits))

    def has(self, h: np.ndarray) -> np.ndarray:
        s = _slot(h)
        return (np.frombuffer(self.bits, np.uint8)[s >> 3] >> (7 - (s & 7)).astype(np.uint8) & 1).astype(bool)


def _hashed(phrases: list[bytes], seed: int) -> np.ndarray:
    """Hashes of whole phrases of one length."""
    columns = [np.array([xxhash.xxh64_intdigest(w, seed) for w in ws], np.uint64) for ws in zip(*[p.split(b" ") for p in phrases])]
    h = columns[0]
    for word in columns[1:]:
        h = _next_hash(h, word)
    return h


def _distinct(ids: np.ndarray, at: np.ndarray, age: np.ndarray, k: int, base: int, ages: int) -> tuple:
    """The distinct runs of ``k`` words that start at ``at``: their words, ages (one
    for each run of words) and counts.  Exact: by the words, not by the hash."""
    if base ** k * ages < 1 << 63:  # a run and its age are one number, and sorting alone counts them
        code = ids[at]
        for j in range(1, k):
            code = code * base + ids[at + j]
        code = np.sort(code * ages + age)
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]]))
        n = np.diff(np.append(first, len(code)))
        code, age = np.divmod(code[first], ages)
        words = []
        for _ in range(k):
            code, word = np.divmod(code, base)
            words.append(word)
        return words[::-1], age, n
    code = ids[at]
    for j in range(1, k):
        code = (np.unique(code, return_inverse=True)[1] if j > 1 else code) * base + ids[at + j]
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return [ids[at[first] + j] for j in range(k)], age[first], n


def _count_chunk(lang: str, texts: list[bytes], max_words: int, step: int, shards: int,
                 past: list[list[Reached]]) -> Iterator[tuple]:
    """(phrases, last steps of their cycles, counts) of the active phrases of
    some texts.  ``past`` tells what was reached before this step and before
    each of the ``shards`` steps back."""
    tokens = _CUT.sub(b" \xff ", b"\n".join(texts).translate(_LOWER)).split()
    ids_of: defaultdict = defaultdict()
    ids_of.default_factory = ids_of.__len__
    ids_of[_STOP]
    ids = np.fromiter(map(ids_of.__getitem__, tokens), np.int64, len(tokens))
    del tokens
    vocab = pa.array(list(ids_of), pa.binary())
    if step < shards:
        n = np.bincount(ids, minlength=len(vocab))
        n[0] = 0
        at = np.flatnonzero(n)
        yield pa.array([b""], pa.binary()), np.array([shards - 1]), np.array([n.sum()])
        yield vocab.take(pa.array(at)), np.full(len(at), shards - 1), n[at]
    seed = xxhash.xxh32_intdigest(lang)
    word = np.array([xxhash.xxh64_intdigest(w, seed) for w in ids_of], np.uint64)
    h, inside = word[ids], ids > 0
    for k in range(2, max_words + 1):
        if len(ids) < k:
            return
        # How many of the steps looked back at already had both parts: 0 is inactive, all is complete.
        at = np.flatnonzero(inside[:-1] & (ids[k - 1:] > 0))
        left, right = h[at], h[at + 1]
        age = np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        for then in past:
            live = live[then[k - 1].has(left[live]) & then[k - 1].has(right[live])]
            age[live] += 1
        inside = inside[:-1] & (ids[k - 1:] > 0)
        h = _next_hash(h[:-1], word[ids[k - 1:]])
        active = (age > 0) & (age <= shards)
        at, age = at[active], age[active]
        words, age, n = _distinct(ids, at, age, k, len(vocab), shards + 1)
        for i in range(0, len(n), 1 << 17):
            cols = [vocab.take(pa.array(w[i:i + (1 << 17)])) for w in words]
            yield pc.binary_join_element_wise(*cols, b" "), step + shards - age[i:i + (1 << 17)], n[i:i + (1 << 17)]


def _step_counts(shard: DataFrame, step: int, max_words: int, shards: int, past: list[list[Reached]]) -> DataFrame:
    """(lang, phrase, done, n) of the active phrases in a shard, by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)

        def out(lang):
            size[lang] = 0
            for phrases, done, n in _count_chunk(lang, held.pop(lang), max_words, step, shards, past):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(phrases), pa.string()), phrases,
                     pa.array(np.asarray(done, np.int32)), pa.array(np.asarray(n, np.int64))], ["lang", "phrase", "done", "n"])
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held[lang].append(text)
                size[lang] += len(text)
                if size[lang] >= CHUNK:
                    yield from out(lang)
            while sum(size.values()) >= 2 * CHUNK:  # many languages: the largest first
                yield from out(max(size, key=size.get))
        for lang in list(held):
            yield from out(lang)
    return shard.select("lang", F.col("text").cast("binary")).mapInArrow(run, "lang string, phrase binary, done int, n long")


def _new_pages(counting: DataFrame, min_count: int, max_words: int) -> list[dict[int, bytes]]:
    """For each length the pages of bits of the phrases that have reached the
    threshold.  The bits are set in the tasks that the pages are dealt to, so
    the driver gets ``max_words`` - 1 times 2^SLOT_BITS bits at most."""
    def slots(batches):
        for b in batches:
            by = defaultdict(list)
            for lang, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by[lang, p.count(b" ") + 1].append(p)
            for (lang, k), phrases in by.items():
                if k < max_words:
                    slot = np.unique(_slot(_hashed(phrases, xxhash.xxh32_intdigest(lang))))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(slot), k, np.int32)), pa.array((slot // (8 * PAGE)).astype(np.int32)),
                         pa.array((slot % (8 * PAGE)).astype(np.int32))], ["k", "page", "bit"])

    def fold(batches):
        pages: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            k, page, bit = (c.to_numpy() for c in b.columns)
            own = k.astype(np.int64) << 32 | page
            for x in np.unique(own).tolist():
                at = (x >> 32, x & 0xFFFFFFFF)
                if at not in pages:
                    pages[at] = np.zeros(8 * PAGE, np.uint8)
                pages[at][bit[own == x]] = 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in pages], pa.int32()), pa.array([p for _, p in pages], pa.int32()),
             pa.array([np.packbits(x).tobytes() for x in pages.values()], pa.binary())], ["k", "page", "bits"])
    rows = counting.where((F.col("n") >= min_count) & (F.length("phrase") > 0)).select("lang", "phrase")
    dealt = rows.mapInArrow(slots, "k int, page int, bit int").repartition(shuffle_partitions(counting.sparkSession), "k", "page")
    out: list[dict[int, bytes]] = [{} for _ in range(max_words)]
    for k, page, bits in dealt.mapInArrow(fold, "k int, page int, bits binary").collect():
        out[k][page] = bytes(bits)
    return out


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10, shards: int = SHARDS) -> DataFrame:
    """(lang, k, phrase, n): all phrases of up to ``max_words`` words with at
    least ``min_count`` occurrences, and the number of all words as k = 0."""
    spark = docs.sparkSession
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    dealt = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
                        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"))
    dealt.write.partitionBy("shard").parquet(folder)
    stored = spark.read.schema(dealt.schema).parquet(folder)
    stored._table_path = folder
    none = [Reached() for _ in range(max_words)]
    past = [none] * (shards + 1)  # before this step, before the last one, .. a cycle ago
    counting: DataFrame | None = None
    complete: list[DataFrame] = []
    step = 0
    while step < shards or any(a.bits != b.bits for a, b in zip(past[0], past[shards])):  # some phrase is active
        rows = _step_counts(stored.where(F.col("shard") == step % shards), step, max_words, shards, past)
        if counting is not None:
            rows = rows.unionByName(counting.where(F.col("done") >= step))
        # Dealt as they are: chunks share few phrases, so adding up before the shuffle would save little.
        totals = (rows.repartition(shuffle_partitions(spark), "lang", "phrase").groupBy("lang", "phrase")
                  .agg(F.max("done").alias("done"), F.sum("n").alias("n")))
        enough = (F.col("n") >= min_count) | (F.length("phrase") == 0)
        now = materialize(totals.where(enough | (F.col("done") > step)))
        complete.append(materialize(now.where(F.col("done") == step)))
        reached = _new_pages(now, min_count, max_words)
        past = [[was.with_slots(pages) for was, pages in zip(past[0], reached)], *past[:shards]]
        discard(*([counting] if counting is not None else []))
        counting = now
        step += 1
    discard(stored, counting)
    phrase = F.col("phrase").cast("string")
    k = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ")))
    return union_all(complete).select("lang", k.alias("k"), phrase.alias("phrase"), "n")


def _part(words, first, count):
    return F.array_join(F.slice(words, first, count), " ")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, cover: int = 50, top: int = 2000,
                 shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    counts = materialize(phrase_counts(docs, max_words, min_count, shards))
    found = materialize(counts.where("k >= 2").select("lang", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words")))
    # Inside longer candidates.
    spans = [F.struct(F.lit(i).alias("i"), F.lit(k).alias("k")) for k in range(2, max_words) for i in range(1, max_words - k + 2)]
    kept = found
    if spans:
        inner = (found.select("lang", "words", "a", "k", F.explode(F.array(*spans)).alias("s"))
                 .where((F.col("s.k") < F.col("k")) & (F.col("s.i") + F.col("s.k") - 1 <= F.col("k")))
                 .select(F.col("lang").alias("_l"), _part(F.col("words"), F.col("s.i"), F.col("s.k")).alias("_p"), "a")
                 .groupBy("_l", "_p").agg(F.max("a").alias("longer")))
        kept = (found.join(inner, (F.col("lang") == F.col("_l")) & (F.col("phrase") == F.col("_p")), "left")
                .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover)))
    cuts = kept.select("lang", "phrase", "a", F.col("k").alias("words_in"), "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part(F.col("words"), F.lit(1), F.col("cut")).alias("left"),
                       _part(F.col("words"), F.col("cut") + 1, F.col("words_in") - F.col("cut")).alias("right"))
    parts = counts.where(F.col("k").between(1, max_words - 1))
    cuts = spread_join(materialize(cuts), parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = spread_join(materialize(cuts), parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    whole = lambda c: F.col(c).cast("decimal(16,0)")
    cuts = cuts.withColumns({"top": F.lit(1000000).cast("decimal(7,0)") * whole("a") * whole("a"), "under": whole("l") * whole("r")})
    lowest = F.min(F.struct(F.expr("top div under").alias("score"), "cut", "l", "r")).alias("low")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession)))
    best = (scored.withColumn("part", salt).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("place") <= top))
    # At most ``top`` rows of each part are left.
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = counts.where("k = 0").select(F.col("lang").alias("_l"), F.col("n").alias("n"))
    return (best.join(total, F.col("lang") == F.col("_l"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")))
