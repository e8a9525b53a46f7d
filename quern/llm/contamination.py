"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (an item of fewer
words, but not none, is one window).  A document holds an item when a window of
it stands in the text; the words inside such places are hit.

Sets.  A window is the set of its shingles of ``SHINGLE`` words (shorter windows
are one shingle).  A document is first reduced to the runs of consecutive
shingles that any window has: nothing outside them can be hit, and runs shorter than the
shortest window go (length bound).  What shingles windows have is known to the tasks as
one bit per slot of 2^24 hashed slots, a fixed size; a shingle taken by its slot
alone only makes a run longer.

Join.  Shingles are ordered by rarity in the documents' runs, ties by text.
Containment is required in full, so the prefix of a window that must be joined is one
shingle, the rarest.  A document's shingle that is the prefix of a window
gives one place where the window may stand (positional bound); places that begin or end
outside the run go (length bound), and the rest is verified word by word.

Scale: the documents are read once, with map-side work only; runs are few.  The
join is by shingle, with shingles that very many documents share dealt to parts
(``spread_join``); each of a window's other shingles stays out of it.  Groups are
one document's places and items, and so bounded by the text and the benchmark.

Defined results: a null text has no words; rows with null or equal ids each get
a row; an item without words has no windows; an item without id hits words but
is not listed; items of one id are one; an empty benchmark hits nothing; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.loops import materialize
from .common import spread_join

SHINGLE = 5
SLOT_BITS = 24
CHUNK = 4 << 20  # bytes of text
_STOP = b"\xff"  # in no UTF-8 text
# A-Z to a-z; 0-9, a-z and all beyond ASCII stay; the rest separates words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC4CEB9FE1A85EC53)


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


def _hashes(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Number (0 for the stop) and hash of every token."""
    ids_of: defaultdict = defaultdict()
    ids_of.default_factory = ids_of.__len__
    ids_of[_STOP]
    ids = np.fromiter(map(ids_of.__getitem__, tokens), np.int64, len(tokens))
    return ids, np.array([xxhash.xxh64_intdigest(w) for w in ids_of], np.uint64)[ids]


def _rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles, by their first word."""
    out = h[:max(0, len(h) - k + 1)].copy()
    for j in range(1, k):
        out = (out * _MUL + h[j:j + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return (out ^ np.uint64(k)) * _MUL


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def item_windows(items: DataFrame, window: int = 10) -> DataFrame:
    """(item, phrase, length) of every window, once per item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {"item": [], "phrase": [], "length": []}
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = _words(text)
                n = min(window, len(ws))
                for phrase in {b" ".join(ws[i:i + n]) for i in range(len(ws) - n + 1)} if n else ():
                    rows["item"].append(item)
                    rows["phrase"].append(phrase)
                    rows["length"].append(n)
            yield pa.RecordBatch.from_arrays([pa.array(rows["item"], pa.string()), pa.array(rows["phrase"], pa.binary()),
                                              pa.array(rows["length"], pa.int32())], ["item", "phrase", "length"])
    found = items.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).mapInArrow(run, "item string, phrase binary, length int")
    return found.select("item", F.col("phrase").cast("string").alias("phrase"), "length").distinct()


def _shingles(words, k):
    return F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.array_join(F.slice(words, i + 1, k), " "))


def _slot_bits(shingles: DataFrame) -> bytes:
    """One bit per slot that a shingle (column shingle) of the benchmark falls on."""
    def run(batches):
        for b in batches:
            hs = [_rolled(_hashes(s.split())[1], s.count(b" ") + 1) for s in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_slots(np.concatenate(hs or [np.zeros(0, np.uint64)]))).astype(np.int32))], ["slot"])
    rows = shingles.select(F.col("shingle").cast("binary")).mapInArrow(run, "slot int").distinct().toPandas()
    bits = np.zeros(1 << SLOT_BITS, bool)
    bits[rows["slot"].to_numpy()] = True
    return np.packbits(bits).tobytes()


def _chunks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def document_runs(docs: DataFrame, bits: bytes, shortest: dict[int, int]) -> DataFrame:
    """(doc_id, n_words, runs of struct(start, k, words)): per shingle length k the
    runs of at least ``shortest[k]`` words whose shingles all fall on ``bits``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in _chunks(texts):
                tokens = (b" \xff ".join([t or b"" for t in texts[lo:hi]])).translate(_WORDS).split()
                ids, h = _hashes(tokens)
                stops = np.flatnonzero(ids == 0)
                begins, ends = np.concatenate(([0], stops + 1)), np.concatenate((stops, [len(ids)]))
                runs: list[list[dict]] = [[] for _ in range(hi - lo)]
                for k, least in shortest.items():
                    s = _slots(_rolled(h, k))
                    on = (table[s >> 3] >> (7 - (s & 7)).astype(np.uint8) & 1).astype(bool)
                    for j in range(k):  # no shingle over two texts
                        on &= ids[j:j + len(on)] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], on.view(np.int8), [0]))))
                    first, last = edge[::2], edge[1::2] + k - 1  # words [first, last)
                    long = last - first >= least
                    for x, y in zip(first[long].tolist(), last[long].tolist()):
                        d = int(np.searchsorted(begins, x, "right")) - 1
                        runs[d].append({"start": x - int(begins[d]), "k": k, "words": tokens[x:y]})
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(ends - begins, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("k", pa.int32()), ("words", pa.list_(pa.binary()))])))],
                    ["doc_id", "n_words", "runs"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start int, k int, words array<binary>>>")


def _places(runs: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """(rid, start, length, phrase): the places where a window stands."""
    reach = F.lit(window) - F.col("k")

    def entry(i):  # a shingle with the words around it that a window could take in
        low = F.greatest(F.lit(0), i - reach)
        return F.struct(F.array_join(F.slice("words", i + 1, F.col("k")), " ").alias("shingle"), (F.col("start") + i).alias("pos"),
                        (i - low).alias("before"), F.slice("words", low + 1, i - low + F.lit(window)).alias("around"))
    at = materialize(runs.select("rid", F.inline(F.transform(F.sequence(F.lit(0), F.size("words") - F.col("k")), entry))))
    rarity = at.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    cut = windows.select("phrase", "length", F.least("length", F.lit(SHINGLE)).alias("k"), F.split("phrase", " ").alias("ws"))
    cut = cut.select("phrase", "length", F.posexplode(_shingles(F.col("ws"), F.col("k"))).alias("offset", "shingle"))
    seen = cut.join(rarity, "shingle", "left")
    first = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("first")
    prefix = seen.groupBy("phrase", "length").agg(first).where("first.n > 0").select("phrase", "length", "first.shingle", "first.offset")
    met = spread_join(at, prefix, ["shingle"])
    begin = F.col("before") - F.col("offset")
    whole = F.array_join(F.slice("around", begin + 1, F.col("length")), " ")
    return (met.where((begin >= 0) & (begin + F.col("length") <= F.size("around"))).where(whole == F.col("phrase"))
            .select("rid", (F.col("pos") - F.col("offset")).alias("start"), "length", "phrase").distinct())


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``."""
    listed = materialize(item_windows(items, window))
    windows = materialize(listed.select("phrase", "length").distinct())
    k = F.least("length", F.lit(SHINGLE))
    shortest = {r["k"]: r["least"] for r in windows.groupBy(k.alias("k")).agg(F.min("length").alias("least")).collect()}
    shingles = windows.select(F.explode(_shingles(F.split("phrase", " "), k)).alias("shingle")).distinct()
    marked = materialize(document_runs(docs, _slot_bits(shingles), shortest).withColumn("rid", F.monotonically_increasing_id()))
    # Written with the words as an array: an expression for it would be computed again for every shingle.
    runs = marked.select("rid", F.explode("runs").alias("r")).select("rid", "r.start", "r.k", F.col("r.words").cast("array<string>").alias("words"))
    places = materialize(_places(runs, windows, window))
    end = F.col("start") + F.col("length")
    before = Window.partitionBy("rid").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    spans = places.select("rid", "start", "length").distinct().withColumn("reached", F.coalesce(F.max(end).over(before), F.lit(0)))
    hits = spans.groupBy("rid").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reached"))).alias("n_hit"))
    named = spread_join(places.select("rid", "phrase").distinct(), listed.where("item IS NOT NULL").select("phrase", "item"), ["phrase"])
    held = named.groupBy("rid").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = marked.select("rid", "doc_id", "n_words").join(hits, "rid", "left").join(held, "rid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
