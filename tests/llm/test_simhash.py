import random

import numpy as np
import pytest
import xxhash
from llm_fixtures import WORD, edge_docs, empty_docs

from quern.llm import simhash


def slow_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{fps[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def test_components_match_brute_force(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in simhash.components(docs).collect()), key=repr)
    assert got == slow_components(rows)
    assert simhash.components(empty_docs(spark)).collect() == []


def _close_fps(n, seed):
    rng = random.Random(seed)
    out = {0, 2 ** 64 - 1}
    while len(out) < n:
        f = rng.getrandbits(64)
        out.add(f)
        for _ in range(rng.randint(0, 3)):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 6)):
                g ^= 1 << b
            out.add(g)
    return np.array(sorted(out), np.uint64).view(np.int64)


def _groups(fps, links):
    parent = {int(f): int(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[find(int(a))] = find(int(b))
    by = {}
    for f in parent:
        by.setdefault(find(f), []).append(f)
    return sorted(sorted(v) for v in by.values())


def test_links_join_what_all_pairs_join(spark):
    fps = _close_fps(1500, 3)
    u = fps.view(np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(u[:, None] ^ u[None, :]) <= 4, 1))
    want = _groups(fps, [(fps[i], fps[j]) for i, j in near])
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    for kw in ({}, {"per_shard": 8}, {"per_shard": 16, "max_shard": 5}, {"blocks": 8, "per_shard": 4}):
        got = simhash.near_links(df, **kw).collect()
        assert _groups(fps, [tuple(r) for r in got]) == want, kw


def test_tree_sends_a_query_to_every_shard_in_reach():
    tree = simhash.BlockTree(8, 1, 40, 1)
    for v in range(256):
        reach = {tree.leaf_of[v], *tree.visits[tree.offsets[v]:tree.offsets[v + 1]]}
        for b in range(8):
            w = v ^ (1 << b)
            back = {tree.leaf_of[w], *tree.visits[tree.offsets[w]:tree.offsets[w + 1]]}
            assert tree.leaf_of[w] in reach or tree.leaf_of[v] in back


def test_keep_one_leaves_one_row_of_each_group(spark):
    docs = edge_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted({c for d, _, c in slow_components(rows) if c is not None and d is not None})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert kept.where("doc_id is null").count() == 0  # both are copies of rows with an id


def test_blocks_wider_than_a_tree_can_hold_raise(spark):
    fps = spark.createDataFrame([(1,), (2,)], "fp long")
    for blocks in (1, 2, 3):
        with pytest.raises(ValueError):
            simhash.near_links(fps, blocks=blocks)
