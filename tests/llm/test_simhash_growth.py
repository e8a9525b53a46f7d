"""What a search costs by fingerprint does not grow with the number of shards."""
import numpy as np
import pytest
from test_simhash import _close_fps, _groups

from quern.llm import simhash


def test_a_query_goes_to_shards_with_a_value_in_reach_only():
    tree = simhash.BlockTree(12, 1, 1000, 3)
    assert np.diff(tree.offsets).max() <= 12  # a value has 12 neighbours
    for v in range(1 << 12):
        near = {tree.leaf_of[v ^ (1 << b)] for b in range(12)}
        assert set(tree.visits[tree.offsets[v]:tree.offsets[v + 1]]) <= near
    assert len(simhash.BlockTree(12, 0, 1000, 3).visits) == 0


def test_entries_of_a_fingerprint_stay_few():
    fps = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63 - 1, 20_000)
    per = [len(simhash._route(fps, simhash._trees(4, 4, leaves, 7), 16)[0]) / len(fps) for leaves in (64, 6000)]
    assert max(per) <= 4 + 16 / 2 + 1  # stored in four shards; half of the neighbours' shards are asked


def test_radii_miss_no_pair():
    for blocks in (4, 8, 16, 64):
        for max_bits in (0, 1, 3, 4, 6, 9):
            r = simhash.radii(blocks, max_bits)
            assert len(r) <= blocks and sum(x + 1 for x in r) == max_bits + 1


@pytest.mark.parametrize("kw", [{"max_bits": 6, "per_shard": 8}, {"max_bits": 9, "per_shard": 16}, {"max_bits": 3, "blocks": 8, "per_shard": 8},
                                {"max_bits": 0, "per_shard": 8}, {"max_bits": 5, "blocks": 16, "per_shard": 64, "max_shard": 40}])
def test_links_for_other_distances(spark, kw):
    fps = _close_fps(700, 11)
    u = fps.view(np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(u[:, None] ^ u[None, :]) <= kw["max_bits"], 1))
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    got = simhash.near_links(df, **kw).collect()
    assert _groups(fps, [tuple(r) for r in got]) == _groups(fps, [(fps[i], fps[j]) for i, j in near])


def test_spanning_links_of_chains_and_stars():
    rng = np.random.default_rng(2)
    chain = np.cumprod(np.full(40, 2, np.uint64)) - np.uint64(1)  # each 1 bit from the next
    star = np.uint64(0xF0F0F0F0F0F0F0F0) ^ (np.uint64(1) << rng.permutation(64)[:20].astype(np.uint64))
    fps = rng.permutation(np.concatenate([chain, star])).view(np.int64)
    for max_bits, groups in ((1, 21), (2, 2)):
        a, b = simhash.shard_links(fps, fps, max_bits)
        assert len(_groups(fps, list(zip(a, b)))) == groups and len(a) == len(fps) - groups


def test_every_shard_above_the_limit(spark):
    fps = _close_fps(150, 21)
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long").coalesce(1)
    plain, cut = ([tuple(r) for r in simhash.near_links(df, **kw).collect()] for kw in ({"per_shard": 4}, {"per_shard": 4, "max_shard": 1}))
    assert _groups(fps, plain) == _groups(fps, cut)
