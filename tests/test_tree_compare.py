"""tree_compare (F9): shared subtrees in a fixed number of tables, against brute
force with null values, keys that collide and ids that repeat."""

import random

import pytest

from quern.operators import hierarchy as hi
from quern.plans import scan
from test_trees import SCHEMA, Slow, random_forest


def trees(spark, *tables):
    return [hi.tree_paths(spark.createDataFrame(t, SCHEMA)) for t in tables]


def odd_values(rows, seed):
    rng = random.Random(seed)
    return [(x, p, s, rng.choice([None, 0, 1])) for x, p, s, _ in rows]


def shapes(rows):
    slow = Slow(rows)

    def shape(x):
        return None if x is None else (slow.val[x], *[shape(slow.kid.get((x, s))) for s in "LR"])
    return [shape(x) for x in slow.val]


@pytest.fixture(scope="module")
def pair(spark):
    a, b = odd_values(random_forest(3, 60, roots=2), 5), odd_values(random_forest(4, 50, roots=1), 6)
    ta, tb = trees(spark, a, b)
    known = set(shapes(a))
    return hi.preorder(ta), hi.preorder(tb), sum(s in known for s in shapes(b)), ta, tb


def test_no_round_per_doubling_of_the_size(pair, monkeypatch):
    writes, keep = [], hi.materialize
    monkeypatch.setattr(hi, "materialize", lambda df: writes.append(1) or keep(df))
    assert hi.tree_compare(pair[3], pair[4]).first()[:] == (False, False, pair[2])
    assert len(writes) == 2  # one a doubling before


def test_pieces_and_nulls(pair, monkeypatch):
    monkeypatch.setattr(scan, "UNKEYED_ROWS", 20)
    assert hi._shared_subtrees(pair[0], pair[1]) == pair[2]


def test_keys_that_collide_are_found_out(pair, monkeypatch):
    monkeypatch.setattr(hi, "_PRIME", 2)
    monkeypatch.setattr(hi, "_BASES", (1, 1))
    assert hi._shared_subtrees(pair[0], pair[1]) is None
    assert hi.tree_compare(pair[3], pair[4]).first().b_subtrees_in_a == pair[2]


def test_only_the_children_differ_under_equal_keys(spark, monkeypatch):
    """1(2, 3) and 1(3, 2) have one key with base 1; no node's token tells them apart."""
    a, b = ([(1, None, "L", 1), (2, 1, "L", x), (3, 1, "R", y)] for x, y in ((2, 3), (3, 2)))
    ta, tb = trees(spark, a, b)
    monkeypatch.setattr(hi, "_BASES", (1, 1))
    assert hi._shared_subtrees(hi.preorder(ta), hi.preorder(tb)) is None
    assert hi.tree_compare(ta, tb).first().b_subtrees_in_a == 2


def test_ids_that_repeat_take_the_naming_by_position(spark):
    rows = [(1, None, "L", 1), (2, 1, "L", 2), (3, 1, "R", 2), (4, 2, "L", 5)]
    ta, tb = trees(spark, rows + rows[-1:], rows)
    assert hi._shared_subtrees(hi.preorder(ta), hi.preorder(tb)) is None
    assert hi._shared_subtrees(hi.preorder(tb), hi.preorder(tb)) == 4
