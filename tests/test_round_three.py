"""Loops that keep their size, contraction, null keys, item windows, timed sums."""
import random

import pytest

from quern.operators import graph, joins, sequences as sq
from quern.plans.loops import discard, materialize, scratch_folder


def test_loop_tables_keep_the_size_of_their_files(spark):
    t = materialize(spark.range(100).selectExpr("id AS x", "(id + 1) % 100 AS y"))
    for _ in range(40):
        up = t.selectExpr("x AS _x", "y AS _y")
        n = materialize(t.join(up, t["y"] == up["_x"]).selectExpr("x", "_y AS y"))
        discard(t)
        t = n
    size = int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size < 1_000_000 and t.count() == 100
    assert scratch_folder(spark) in t._table_path


@pytest.mark.parametrize("size", [60, 20_000])
def test_shuffled_paths_contract_in_few_rounds(spark, size, monkeypatch):
    rounds = []
    real = graph._contract
    monkeypatch.setattr(graph, "_contract", lambda *a: rounds.append(1) or real(*a))
    ids = list(range(size))
    random.Random(size).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "src long, dst long")
    got = graph.connected_components(edges).selectExpr("count(*)", "count(distinct node)", "max(comp)").first()
    assert tuple(got) == (size, size, 0) and len(rounds) < 20


def test_components_match_union_find(spark):
    rng = random.Random(8)
    edges = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(220)] + [("hub", f"n{i}") for i in range(0, 300, 7)]
    edges += [("a", "a"), (None, "b"), ("n1", None)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    df = spark.createDataFrame(edges, "src string, dst string")
    want = {x: find(x) for x in up}
    got = {r.node: r.comp for r in graph.connected_components(df).collect()}
    assert got == want
    half = graph.connected_components(df.limit(100))
    rest = spark.createDataFrame(edges[100:], "src string, dst string")
    assert {r.node: r.comp for r in graph.connected_components(rest, initial=half).collect()} == want


def test_null_keys(spark):
    s = spark.createDataFrame([(None, 1, 4), (None, 2, 5), (None, 3, 5), ("a", 1, 7)], "k string, p long, v long")
    u = spark.createDataFrame([(None, 2, 9, 1), (None, 2, 6, 2), (None, 9, 1, 1)], "k string, p long, v long, ts long")
    q = spark.createDataFrame([(None, 1, 3), (None, 1, 9), ("a", 1, 3)], "k string, lo long, hi long")
    got = {(r.k, r.hi): r.range_sum for r in sq.range_sum_query(s, q, ["k"], "p", "v", updates=u).collect()}
    assert got == {(None, 3): 15, (None, 9): 16, ("a", 3): 7}
    got = sq.range_update(spark.createDataFrame([(None, 1, 3)], "k string, a long, b long"), "a", "b", keys=["k"]).collect()
    assert [r.value for r in sorted(got, key=lambda r: r.pos)] == [1, 1, 1]
    pair = joins.first_complement_pair(spark.createDataFrame([(None, 1, 3), (None, 2, 7), (None, 3, 5), (None, 4, 5)], "k string, id long, v long"),
                                       ["k"], "v", "id", 10).collect()
    assert len(pair) == 1 and {1, 2} <= set(pair[0])


def test_k_distinct_windows_of_any_items(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.choice(["a", "b", "c", "d", "e", "q", None][: 2 + k])) for k in range(6) for i in range(60)]
    rows += [(None, i, x) for i, x in enumerate("abqcqdqe")]
    df = spark.createDataFrame(rows, "k long, pos long, item string")
    for n in (1, 2, 3):
        want = {}
        for key in {r[0] for r in rows}:
            items = [x for k, _, x in sorted((r for r in rows if r[0] == key), key=lambda r: r[1])]
            want[key] = max(j - i for i in range(len(items)) for j in range(i + 1, len(items) + 1) if len(set(items[i:j])) <= n)
        assert {r.k: r.longest_k_distinct for r in sq.k_distinct_window(df, ["k"], ["pos"], "item", n).collect()} == want
    assert want[None] == 5


def test_timed_range_sums(spark):
    rng = random.Random(6)
    ups = [(rng.choice(["x", None]), rng.randint(-5, 30), rng.choice([None, *range(9)]), t) for t in range(200)]
    asked = [(rng.choice(["x", None, "z"]), rng.randint(-9, 20), rng.randint(-9, 40), rng.randint(-1, 210)) for _ in range(80)]
    u = spark.createDataFrame(ups, "k string, pos long, val long, ts long")
    q = spark.createDataFrame(asked, "k string, lo long, hi long, ts long")

    def slow(k, lo, hi, ts):
        now = {}
        for key, pos, val, t in ups:
            if key == k and t <= ts:
                now[pos] = val or 0
        return sum(v for p, v in now.items() if lo <= p <= hi)
    got = sorted(((r.k or "", r.lo, r.hi, r.ts, r.range_sum) for r in sq.timed_range_sums(u, q, ["k"], "pos", "val", "ts").collect()))
    assert got == sorted((k or "", lo, hi, ts, slow(k, lo, hi, ts)) for k, lo, hi, ts in asked)
    assert sq.timed_range_sums(u.limit(0), q, ["k"], "pos", "val", "ts").selectExpr("sum(range_sum)").first()[0] == 0
