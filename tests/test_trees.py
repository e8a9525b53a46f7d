"""Trees by pointer doubling: brute force on random trees and forests, a chain
of 100,000 nodes in a logarithmic number of rounds, cycles, exact subtrees."""

import random

from quern.operators import hierarchy as hi
from quern.plans import lifting

SCHEMA = "id long, parent long, side string, val long"


def random_forest(seed, n, roots=2):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    free, rows = [], []
    for i, x in enumerate(ids):
        if i < roots:
            rows.append((x, None, "L", rng.randint(-3, 3)))
        else:
            parent, side = free.pop(rng.randrange(len(free)))
            rows.append((x, parent, side, rng.randint(-3, 3)))
        free += [(x, "L"), (x, "R")]
    return rows


class Slow:
    def __init__(self, rows):
        self.val = {r[0]: r[3] for r in rows}
        self.parent = {r[0]: r[1] for r in rows}
        self.kid = {(r[1], r[2]): r[0] for r in rows if r[1] is not None}
        self.roots = sorted(r[0] for r in rows if r[1] is None)

    def path(self, x):
        out = [x]
        while self.parent[out[-1]] is not None:
            out.append(self.parent[out[-1]])
        return out

    def walk(self, order, x):
        if x is None:
            return []
        left, right = (self.walk(order, self.kid.get((x, s))) for s in "LR")
        return {"pre": [x] + left + right, "in": left + [x] + right, "post": left + right + [x]}[order]

    def orders(self, order):
        return [x for r in self.roots for x in self.walk(order, r)]

    def down(self, x):
        """(height, gain, shape) of the subtree of x."""
        kids = [self.down(self.kid[x, s]) if (x, s) in self.kid else None for s in "LR"]
        return (1 + max(k[0] if k else -1 for k in kids), self.val[x] + max(0, *[k[1] if k else 0 for k in kids]),
                (self.val[x], *[k[2] if k else None for k in kids]))


def test_random_forest(spark):
    n = 75
    rows = random_forest(2, n)
    slow, tree = Slow(rows), hi.tree_paths(spark.createDataFrame(rows, SCHEMA))
    got = {r.id: r for r in tree.rows.collect()}
    assert {x: (r.level, r.psum) for x, r in got.items()} == {
        x: (len(slow.path(x)) - 1, sum(slow.val[y] for y in slow.path(x))) for x in slow.val}
    order = hi.traversal_order(tree).collect()
    for kind in ("pre", "in", "post"):
        assert [r.id for r in sorted(order, key=lambda r: r[f"{kind}_pos"])] == slow.orders(kind)
        assert sorted(r[f"{kind}_pos"] for r in order) == list(range(1, n + 1))
    for r in hi.subtree_stats(tree).collect():
        assert (r.height, r.gain) == slow.down(r.id)[:2]
    for r in hi.segment_paths(tree, 2).collect():
        sums, total, run = 0, 0, 1
        path = slow.path(r.id)
        for y in path:
            total += slow.val[y]
            sums += total == 2
        for y, above in zip(path, path[1:]):
            if slow.val[y] != slow.val[above] + 1:
                break
            run += 1
        assert (r.n_paths, r.run) == (sums, run)
    pre = slow.orders("pre")
    for r in hi.tree_levels(tree).collect():
        level = [x for x in pre if len(slow.path(x)) - 1 == r.level]
        at = level.index(r.id)
        assert r.pos_in_level == at + 1 and r.right_neighbour == (level[at + 1] if at + 1 < len(level) else None)
    for r in hi.root_paths(tree, 0).collect():
        path = slow.path(r.id)[::-1]
        assert r.path_text == "->".join(str(slow.val[y]) for y in path)
        assert r.digit_text == "".join(str(slow.val[y] % 10) for y in path)
    pairs = spark.createDataFrame([(x, y) for x in list(slow.val)[::3] for y in list(slow.val)[::4]] + [(-1, rows[0][0])],
                                  "a long, b long")
    lca = hi.lowest_common_ancestor(tree, pairs, "a", "b").collect()
    assert len(lca) == pairs.count() - 1
    for r in lca:
        shared = set(slow.path(r.b))
        assert r.lca == next((y for y in slow.path(r.a) if y in shared), None)


def test_chain_of_100000_nodes_in_logarithmic_rounds(spark, monkeypatch):
    n, writes = 100_000, []
    keep = lifting.materialize
    monkeypatch.setattr(lifting, "materialize", lambda df: writes.append(1) or keep(df))
    nodes = spark.range(n).selectExpr("(id * 7919) % 100003 AS id", "CASE WHEN id > 0 THEN ((id - 1) * 7919) % 100003 END AS parent",
                                      "'L' AS side", "1L AS val")
    tree = hi.tree_paths(nodes)
    assert tree.rows.selectExpr("count(*)", "max(level)", "sum(level)").first()[:] == (n, n - 1, n * (n - 1) // 2)
    top = hi.subtree_stats(tree).selectExpr("max(height)", "max(gain)", "sum(height)").first()
    assert top[:] == (n - 1, n, n * (n - 1) // 2)
    assert len(tree.lifts) == 17 and len(writes) <= 2 * 17 + 3


def test_cycles_missing_parents_and_empty_tables(spark):
    rows = [(1, None, "L", 1), (2, 1, "L", 2), (3, 4, "L", 1), (4, 3, "R", 1), (5, 4, "L", 1), (6, 99, "R", 7), (7, 6, None, None)]
    tree = hi.tree_paths(spark.createDataFrame(rows, SCHEMA))
    assert {(r.id, r.level, r.psum) for r in tree.rows.collect()} == {(1, 0, 1), (2, 1, 3), (6, 0, 7), (7, 1, None)}
    empty = hi.tree_paths(spark.createDataFrame([], SCHEMA))
    assert hi.traversal_order(empty).count() == 0 and hi.tree_levels(empty).count() == 0
    assert hi.subtree_stats(empty).count() == 0 and hi.root_paths(empty, 0).count() == 0
    assert hi.tree_compare(empty, empty).first()[:] == (True, True, 0)


def test_subtrees_are_compared_exactly(spark):
    a, b = ([(x, p, s, v % 2) for x, p, s, v in random_forest(seed, 30, roots=1)] for seed in (3, 13))
    sa, sb = Slow(a), Slow(b)
    shapes = {sa.down(x)[2] for x in sa.val}
    ta, tb = (hi.tree_paths(spark.createDataFrame(r, SCHEMA)) for r in (a, b))
    got = hi.tree_compare(ta, tb).first()
    assert (got.equal, got.mirror, got.b_subtrees_in_a) == (False, False, sum(sb.down(x)[2] in shapes for x in sb.val))
    flipped = [(x, p, "R" if s == "L" else "L", v) for x, p, s, v in a]
    got = hi.tree_compare(ta, hi.tree_paths(spark.createDataFrame(flipped, SCHEMA))).first()
    assert got.mirror and not got.equal
    assert hi.tree_compare(ta, ta).first()[:] == (True, False, 30)
