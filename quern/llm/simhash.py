"""SimHash near-duplicates found with vantage-point trees.

Fingerprints: 64 bits over the XXH64 (seed 42) of all word shingles of a whole
text, repeats included; a bit is set when it is set in more than half of the
hashes.  Equal fingerprints are one node; nodes at ``max_bits`` or fewer
differing bits are linked; a document's component is the smallest id it can
reach.

Search: Hamming distance over a block of the bits is a metric too.  Give each
of ``blocks`` equal blocks a radius such that the radii, one added to each, sum
to ``max_bits`` + 1: of two fingerprints that lie farther apart than the radius in every
block each block would hold more differing bits than its radius, all blocks more
than ``max_bits``.  So of two within ``max_bits`` some block is within its own
radius (4 bits and 4 blocks: radius 1 in one block, 0 in the others; a block left
without a share has no tree).  There is one vantage-point tree per block, of
``WIDEST`` bits at most (a tree is laid out over all values of its block).  A
node of a tree splits its values by their distance to a vantage point at the median; a fingerprint is
stored in one leaf (shard) and also sent, as a query, to every shard whose
side of a split the triangle bound cannot rule out and that holds a value within
the radius (the second test up to ``EXACT_REACH`` neighbours of a value): with 16-bit
blocks and radius 1 to 16 other shards at most however deep the tree, with
radius 0 to none, where one tree over 64 bits would send it to most of them.
A pair is looked for from one side only.

Each shard compares its stored fingerprints with its queries exactly, over all
64 bits.  It returns a spanning forest of the links it found, not the pairs,
so a large group of near copies gives as many rows as it has fingerprints.
Shards larger than ``max_shard`` are cut into a grid of (stored part x query
part) tasks, all of them compared.

The trees depend on ``seed`` and the number of fingerprints only, so a lost
executor rebuilds the same shards.  A tree is a table over the 2^16 values of
a block, a fixed size.  The links are merged by the library's distributed
component search.

Defined results: a null, empty or blank text has fingerprint zero, linked like
any other; a text shorter than a shingle is one shingle; null ids keep a row
and never are a component's id unless nothing else is in it (then null);
repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..plans.loops import materialize

BITS = 64
WIDEST = 16
EXACT_REACH = 256  # values within the radius of one, up to which a tree looks at each
TASKS = 1 << 13  # stored parts, and query parts, of one shard at most
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of one text, as a signed 64-bit integer."""
    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not toks:
        return 0
    joined = b" ".join(toks)
    ends = np.cumsum(np.fromiter(map(len, toks), np.int64, len(toks)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(toks))
    s, e = starts[: len(toks) - k + 1], ends[k - 1:]
    set_bits = np.zeros(BITS, np.int64)  # highest bit first, as the digests have it
    for i in range(0, len(s), 4096):
        hs = b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in zip(s[i:i + 4096].tolist(), e[i:i + 4096].tolist())])
        set_bits += np.unpackbits(np.frombuffer(hs, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(s)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp, th) of every row; th is a hash of the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps, b.column(2)], ["doc_id", "fp", "th"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text").alias("th")).mapInArrow(
        run, "doc_id long, fp long, th long")


class BlockTree:
    """A vantage-point tree over the values of a ``width``-bit block.

    ``leaf_of[v]`` is the shard that stores value v; ``visits`` lists, value by
    value, the other shards a query for v must reach."""

    def __init__(self, width: int, radius: int, leaves: int, seed: int):
        values = np.arange(1 << width, dtype=np.uint32)
        rng = np.random.default_rng(seed)
        self.leaf_of = np.zeros(len(values), np.int64)
        self.leaves = 0
        self._visit_values: list[np.ndarray] = []
        self._visit_leaves: list[np.ndarray] = []
        self._split(values, values[:0], max(1, len(values) // leaves), radius, rng)
        v, leaf = np.concatenate(self._visit_values), np.concatenate(self._visit_leaves)
        near = sum(math.comb(width, r) for r in range(1, radius + 1))
        if 0 < near <= EXACT_REACH:
            steps = [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in itertools.combinations(range(width), r)]
            within = np.unique(np.concatenate([values.astype(np.int64) * self.leaves + self.leaf_of[values ^ np.uint32(x)] for x in steps]))
            asked = np.isin(v.astype(np.int64) * self.leaves + leaf, within)
            v, leaf = v[asked], leaf[asked]
        by = np.argsort(v, kind="stable")
        self.visits = leaf[by]
        self.offsets = np.searchsorted(v[by], np.arange(len(values) + 1))

    def _split(self, own: np.ndarray, guests: np.ndarray, target: int, radius: int, rng) -> None:
        if len(own) <= target:
            self.leaf_of[own] = self.leaves
            self._visit_values.append(guests)
            self._visit_leaves.append(np.full(len(guests), self.leaves))
            self.leaves += 1
            return
        vantage = own[rng.integers(len(own))]
        d, g = np.bitwise_count(own ^ vantage).astype(int), np.bitwise_count(guests ^ vantage).astype(int)
        cuts = [m for m in np.unique(d)[:-1]]  # both sides hold a value
        mu = min(cuts, key=lambda m: abs(2 * np.count_nonzero(d <= m) - len(d)))
        inner, outer = own[d <= mu], own[d > mu]
        # Triangle bound: a query at distance x of the vantage point may match
        # inside values only if x <= mu + radius, outside ones only if x > mu - radius.
        self._split(inner, guests[g <= mu + radius], target, radius, rng)
        near = inner[d[d <= mu] > mu - radius]  # own pairs across the cut: asked from inside only
        self._split(outer, np.concatenate([guests[g > mu - radius], near]), target, radius, rng)


def radii(blocks: int, max_bits: int) -> list[int]:
    """Radius of each block that has a tree: with one added to each they sum to ``max_bits`` + 1."""
    share, more = divmod(max(max_bits, 0) + 1, blocks)
    return [share - 1 + (i < more) for i in range(blocks if share else more)]


@functools.lru_cache(maxsize=2)  # once per Python worker
def _trees(blocks: int, max_bits: int, leaves: int, seed: int) -> list[BlockTree]:
    return [BlockTree(BITS // blocks, r, leaves, seed + i) for i, r in enumerate(radii(blocks, max_bits))]


def _block_values(fps: np.ndarray, b: int, width: int) -> np.ndarray:
    return ((fps.view(np.uint64) >> np.uint64(b * width)) & np.uint64((1 << width) - 1)).astype(np.int64)


def _each(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every index as often as ``times`` says, and the how-manieth it is of its own."""
    idx = np.repeat(np.arange(len(times)), times)
    return idx, np.arange(len(idx)) - np.repeat(np.cumsum(times) - times, times)


def _route(fps: np.ndarray, trees: list[BlockTree], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, shard, 1 if stored there else 0)."""
    out = []
    for b, tree in enumerate(trees):
        v = _block_values(fps, b, width)
        idx, nth = _each(tree.offsets[v + 1] - tree.offsets[v])
        at = tree.offsets[v[idx]] + nth
        base = b << 32
        out.append((np.arange(len(v)), base + tree.leaf_of[v], np.ones(len(v), np.int8)))
        out.append((idx, base + tree.visits[at], np.zeros(len(idx), np.int8)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give nodes joined by the pairs (a, b), and what they were joined to
    before, their least label; a label is a node that has itself as label."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def shard_links(stored: np.ndarray, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the pairs (stored, query) within ``max_bits``: each
    fingerprint that has a link, with the least one it is joined to here."""
    nodes = np.unique(np.concatenate([stored, queries]))
    s, q = np.unique(stored), np.unique(queries)
    sid, qid = np.searchsorted(nodes, s), np.searchsorted(nodes, q)
    label = np.arange(len(nodes))
    us, uq = s.view(np.uint64), q.view(np.uint64)
    step = max(1, 250_000 // max(1, len(uq)))
    for i in range(0, len(us), step):
        hit = np.flatnonzero(np.bitwise_count(us[i:i + step, None] ^ uq[None, :]) <= max_bits)
        _merge(label, sid[i + hit // len(uq)], qid[hit % len(uq)])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def near_links(fps: DataFrame, max_bits: int = 4, blocks: int = 4, per_shard: int = 512, max_shard: int = 8192,
               seed: int = 7) -> DataFrame:
    """(a, b) links that join every two of the distinct fingerprints ``fps``
    (column fp) within ``max_bits``, directly or through others."""
    width = BITS // blocks
    if BITS % blocks or width > WIDEST:
        raise ValueError(f"{blocks} blocks: {BITS} bits need equal blocks of {WIDEST} bits or fewer")
    n = fps.count()
    leaves = max(1, min(1 << width, -(-n // per_shard)))
    plan = (blocks, max_bits, leaves, seed)

    def counted(batches):
        trees = _trees(*plan)
        have = np.zeros((len(trees), 1 << width), np.int64)  # rows by block and value
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for b in range(len(trees)):
                have[b] += np.bincount(_block_values(fp, b, width), minlength=1 << width)
        for b, tree in enumerate(trees):
            sent = np.bincount(tree.visits, np.repeat(have[b], np.diff(tree.offsets)), tree.leaves)
            size = np.stack([sent, np.bincount(tree.leaf_of, have[b], tree.leaves)], axis=1).astype(np.int64).ravel()
            at = np.flatnonzero(size)
            yield pa.RecordBatch.from_arrays([pa.array((b << 33) + at), pa.array(size[at])], ["k", "n"])

    # Shards above max_shard: at most one entry per leaf and role, 2 x blocks x 2^width rows.
    heavy = {r["k"]: -(-r["n"] // max_shard) for r in
             fps.select("fp").mapInArrow(counted, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
             .where(F.col("n") > max_shard).collect()}
    # Stored parts and query parts of each of their shards; stored ones are queries of the other parts too.
    large = np.array(sorted({k >> 1 for k in heavy}), np.int64)
    parts_s = np.array([heavy.get(leaf * 2 + 1, 1) for leaf in large.tolist()], np.int64)
    parts_q = parts_s + np.array([heavy.get(leaf * 2, 1) for leaf in large.tolist()], np.int64)

    def routed(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            idx, shard, kept = _route(fp, _trees(*plan), width)
            v = fp[idx]
            rows = [(shard * TASKS * TASKS, v, kept)]
            big = np.isin(shard, large)
            if big.any():
                rows = [(shard[~big] * TASKS * TASKS, v[~big], kept[~big])]
                at, v, kept = np.searchsorted(large, shard[big]), v[big], kept[big]
                part = (v.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64)
                of, j = _each(parts_q[at] * (kept == 1))
                i = part[of] % parts_s[at[of]]
                rows.append(((large[at[of]] * TASKS + i) * TASKS + j, v[of], np.ones(len(of), np.int8)))
                of, i = _each(parts_s[at])
                j = part[of] % parts_q[at[of]]
                rows.append(((large[at[of]] * TASKS + i) * TASKS + j, v[of], np.zeros(len(of), np.int8)))
            k, v, r = (np.concatenate(x) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(r)], ["k", "fp", "stored"])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        v, kept = pdf["fp"].to_numpy(), pdf["stored"].to_numpy() == 1
        a, b = shard_links(v[kept], v, max_bits)
        return pd.DataFrame({"a": a, "b": b})

    rows = fps.select("fp").mapInArrow(routed, "k long, fp long, stored byte")
    return rows.groupBy("k").applyInPandas(compare, "a long, b long")


def _grouped(marked: DataFrame, max_bits: int, **search) -> DataFrame:
    """(fp, least, comp) of every fingerprint: its least id and its component's name."""
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    links = materialize(near_links(nodes, max_bits, **search))
    merged = connected_components(links, "a", "b").select(F.col("node").alias("fp"), "comp")
    return nodes.join(merged, "fp", "left").select("fp", "least", F.coalesce("comp", "fp").alias("comp"))


def components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, **search) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    marked = materialize(fingerprints(docs, shingle))
    grouped = _grouped(marked, max_bits, **search)
    least = grouped.groupBy("comp").agg(F.min("least").alias("component_id"))
    label = grouped.join(least, "comp").select("fp", "component_id")
    return marked.join(label, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, **search) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with
    the least id stays (null last; of equal ids the one with the least
    fingerprint, then text hash), whatever else has that id.  Of rows equal in
    id and text one stays.  The columns may have any names."""
    marked = materialize(fingerprints(docs, shingle))
    at = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("fp"), F.col("th"))
    # Least row of a fingerprint first, so a large component's rows are not joined.
    first = marked.groupBy("fp").agg(F.min(at).alias("at"))
    kept = (first.join(_grouped(marked, max_bits, **search).select("fp", "comp"), "fp").groupBy("comp").agg(F.min("at").alias("at"))
            .select(F.col("at.id").alias("kept_id"), F.col("at.th").alias("kept_th")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"))
    named = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("th") == F.col("kept_th")))
    # An aggregate, not a window: a row repeated very often is reduced before the shuffle.
    return named.groupBy("id", "th").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row.*")
