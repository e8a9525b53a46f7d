"""Operators on random small inputs against brute force in plain Python."""

import itertools
import random

import pytest

from quern.operators import graph as gr
from quern.operators import joins as jn
from quern.operators import sequences as sq


def _lev(a, b):
    d = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        prev, d[0] = d[0], i
        for j, cb in enumerate(b, 1):
            prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (ca != cb))
    return d[-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_edit_distance_join(spark, seed):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(60)}
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for k in (1, 2):
        got = {(r.w1, r.w2, r.distance) for r in jn.edit_distance_join(df, "w", k).collect()}
        exp = {(a, b, _lev(a, b)) for a, b in itertools.combinations(sorted(words), 2) if _lev(a, b) <= k}
        assert got == exp


def test_hamming_join(spark):
    rnd = random.Random(5)
    codes = [(i, rnd.getrandbits(64) - (1 << 63)) for i in range(120)]
    signed = lambda v: ((v + (1 << 63)) % (1 << 64)) - (1 << 63)
    codes += [(1000 + i, signed(c ^ (1 << rnd.randrange(64)))) for i, c in codes[:30]]  # near copies
    df = spark.createDataFrame(codes, "id long, code long")
    for d in (3, 20):
        got = {(r.id_a, r.id_b, r.distance) for r in jn.hamming_join(df, "id", "code", d).collect()}
        exp = set()
        for (a, x), (b, y) in itertools.combinations(sorted(codes), 2):
            dist = bin((x ^ y) & ((1 << 64) - 1)).count("1")
            if dist <= d:
                exp.add((a, b, dist))
        assert got == exp


def test_segments_with_sum(spark):
    rnd = random.Random(3)
    rows = [(k, i, rnd.randint(-3, 3)) for k in range(6) for i in range(rnd.randint(1, 25))]
    df = spark.createDataFrame(rows, "k long, pos long, v long")
    got = {r.k: r.segments for r in sq.segments_with_sum(df, ["k"], ["pos"], "v", 2).collect()}
    for k in range(6):
        vals = [v for kk, _, v in rows if kk == k]
        exp = sum(1 for i in range(len(vals)) for j in range(i, len(vals)) if sum(vals[i:j + 1]) == 2)
        assert got[k] == exp


def test_interval_and_box_overlap(spark):
    rnd = random.Random(9)
    a = [(0, i, s, s + rnd.randint(0, 200)) for i, s in enumerate(rnd.sample(range(1000), 40))]
    b = [(0, 100 + i, s, s + rnd.randint(0, 200)) for i, s in enumerate(rnd.sample(range(1000), 40))]
    da = spark.createDataFrame(a, "k long, a_id long, st long, en long")
    db = spark.createDataFrame(b, "k long, b_id long, st long, en long")
    got = {(r.a_id, r.b_id, r.overlap) for r in jn.interval_overlap_join(da, db, ["k"], "a_id", "b_id", width=37).collect()}
    exp = {(i, j, min(e1, e2) - max(s1, s2) + 1) for _, i, s1, e1 in a for _, j, s2, e2 in b if max(s1, s2) <= min(e1, e2)}
    assert got == exp
    boxes = [(i, x, y, x + rnd.randint(1, 30), y + rnd.randint(1, 30))
             for i, (x, y) in enumerate((rnd.randint(0, 100), rnd.randint(0, 100)) for _ in range(60))]
    dfb = spark.createDataFrame(boxes, "id long, x1 long, y1 long, x2 long, y2 long")
    got = {(r.id_a, r.id_b, r.overlap_area) for r in jn.box_overlap_join(dfb, "id", "x1", "y1", "x2", "y2", cell=7).collect()}
    exp = set()
    for (i, ax1, ay1, ax2, ay2), (j, bx1, by1, bx2, by2) in itertools.combinations(boxes, 2):
        w, h = min(ax2, bx2) - max(ax1, bx1), min(ay2, by2) - max(ay1, by1)
        if w > 0 and h > 0:
            exp.add((i, j, w * h))
    assert got == exp


def test_k_distinct_and_repeat_windows(spark):
    rnd = random.Random(4)
    rows = [(k, i, rnd.choice("abcd")) for k in range(5) for i in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(rows, "k long, pos long, item string")
    got2 = {r.k: r.longest_k_distinct for r in sq.k_distinct_window(df, ["k"], ["pos"], "item", 2).collect()}
    got1 = {r.k: r.longest_distinct for r in sq.last_repeat_window(df, ["k"], ["pos"], "item").collect()}
    for k in range(5):
        s = [it for kk, _, it in rows if kk == k]
        best2 = max(j - i for i in range(len(s)) for j in range(i + 1, len(s) + 1) if len(set(s[i:j])) <= 2)
        best1 = max(j - i for i in range(len(s)) for j in range(i + 1, len(s) + 1) if len(set(s[i:j])) == j - i)
        assert got2[k] == best2 and got1[k] == best1


def test_rate_limit_random(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.choice("xy"), rnd.randint(0, 300)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, key string, t long")
    got = {r.id: r.allowed for r in sq.rate_limit(df, ["key"], "t", "id", 10).collect()}
    last = {}
    for i, key, t in sorted(rows, key=lambda r: (r[2], r[0])):
        ok = key not in last or t >= last[key] + 10
        if ok:
            last[key] = t
        assert got[i] == ok


def test_connected_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.comp for r in gr.connected_components(df).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    nodes = {x for e in edges for x in e if e[0] != e[1]} | {a for a, b in edges if a != b}
    for n in nodes:
        members = [m for m in nodes if find(m) == find(n)]
        assert got[n] == min(members)
