"""Cases the driver tables do not hold: NULL keys and values, duplicate
probes, deep trees, wide grids, quoted CSV fields, very large counts."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quern.operators import aggregates as ag
from quern.operators import graph as gr
from quern.operators import grid as gd
from quern.operators import hierarchy as hi
from quern.operators import joins as jn
from quern.operators import predicates as pr
from quern.operators import sequences as sq
from quern.operators import sorts as so
from quern.operators import text as tj


@pytest.fixture(scope="module")
def series(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, None, "a", "b"]), i, rnd.choice([None, 1, 2, 2, 3, 5])) for i in range(80)]
    return rows, spark.createDataFrame(rows, "k string, i long, v long").persist()


def groups(rows):
    by = defaultdict(list)
    for k, i, v in rows:
        by[k].append((i, v))
    return {k: sorted(x) for k, x in by.items()}


def test_insert_rank_with_equal_probes_and_null_keys(spark):
    v = spark.createDataFrame([("a", 1), ("a", 2), ("a", 5), (None, 3), ("a", None)], "k string, v long")
    p = spark.createDataFrame([("a", 3, 1), ("a", 3, 1), (None, 9, 2), ("z", 1, 3), ("a", 2, 4)], "k string, p long, x long")
    got = sorted((tuple(r) for r in pr.insert_rank(v, p, "k", "v", "p").collect()), key=repr)
    assert got == sorted([("a", 3, 1, 2), ("a", 3, 1, 2), (None, 9, 2, 1), ("z", 1, 3, 0), ("a", 2, 4, 1)], key=repr)


def test_moving_average_skips_nulls(spark, series):
    rows, df = series
    got = {r.i: r.moving_avg for r in sq.moving_average(df, ["k"], ["i"], "v", 3).collect()}
    for x in groups(rows).values():
        for j, (i, _) in enumerate(x):
            seen = [v for _, v in x[max(0, j - 2): j + 1] if v is not None]
            assert got[i] == (pytest.approx(sum(seen) / len(seen)) if seen else None)


def test_null_keys_are_a_key(spark, series):
    rows, df = series
    by = groups(rows)
    full = df.where("v is not null")
    vals = {k: [v for _, v in x if v is not None] for k, x in by.items()}
    got = {r.i: r.greater_sum for r in sq.greater_sum(full, ["k"], "v").collect()}
    assert len(got) == full.count()
    assert all(got[i] == sum(w for w in vals[k] if w >= v) for k, i, v in rows if v is not None)
    got = {r.i: r.n_smaller for r in so.rank_smaller(full, ["k"], "v").collect()}
    assert all(got[i] == sum(w < v for w in vals[k]) for k, i, v in rows if v is not None)

    def segments(x, k):
        return sum(sum(x[a:b]) == k for a in range(len(x)) for b in range(a + 1, len(x) + 1))
    got = {r.k: r.segments for r in sq.segments_with_sum(full, ["k"], ["i"], "v", 5).collect()}
    assert got == {k: segments(x, 5) for k, x in vals.items()}

    def longest(x):
        best = n = 0
        for v in x:
            n = n + 1 if v == 2 else 0
            best = max(best, n)
        return best
    got = {r.k: r.longest_run for r in sq.longest_run(full, ["k"], ["i"], F.col("v") == 2).collect()}
    assert got == {k: longest(x) for k, x in vals.items()}
    got = {r.k: r.first_missing for r in sq.first_missing_positive(full, ["k"], "v").collect()}
    assert got == {k: next(i for i in range(1, 99) if i not in x) for k, x in vals.items()}
    assert {r.k for r in sq.balance_point(full, ["k"], ["i"], "v", "i").collect()} == set(vals)
    assert sq.leave_one_out(full, ["k"], "v").count() == full.count()
    assert {r.k for r in sq.interval_conflicts(full.withColumn("e", F.col("i") + F.col("v")), ["k"], "i", "e").collect()} == set(vals)
    assert sq.recent_count(full, ["k"], "v", 1, "i").count() == full.count()
    single = {k: next((i for i, v in x if v is not None and vals[k].count(v) == 1), -1) for k, x in by.items()}
    assert {r.k: r.first_unique for r in ag.first_unique(full, ["k"], "v", ["i"], "i").collect()} == single
    near = {r.k: r.has_near_duplicate for r in jn.near_duplicates(full, ["k"], ["i"], "v", 2, 0).collect()}
    assert near == {k: any(a < b <= a + 2 and x[a] == x[b] for a in range(len(x)) for b in range(len(x))) for k, x in vals.items()}


def test_counts_of_many_equal_values_are_exact(spark):
    n = 3_000_000
    one = spark.range(1).select(F.lit(n).cast("long").alias("c"), F.lit(10 ** 7).cast("long").alias("d"))
    row = one.select(jn._comb(F.col("c"), 3).alias("a"), jn._comb(F.col("d"), 2).alias("b"), jn._comb(F.col("c"), 4).alias("e")).first()
    assert (int(row.a), int(row.b), int(row.e)) == (math.comb(n, 3), math.comb(10 ** 7, 2), math.comb(n, 4))


def test_deep_tree(spark):
    n = 70
    nodes = spark.createDataFrame([(i, i - 1 if i else None, "L" if i % 2 else "R", i % 10) for i in range(n)],
                                  "id long, parent long, side string, val long")
    paths = hi.tree_paths(nodes)
    leaf = hi.root_paths(paths, 0).first()
    assert leaf.digit_text == "".join(str(i % 10) for i in range(n)) and leaf.digit_number is None
    assert {r.id: r.level for r in hi.tree_levels(paths).collect()} == {i: i for i in range(n)}


def test_islands_far_apart_in_a_wide_grid(spark):
    cells = spark.createDataFrame([(0, 1048576, 1), (1, 0, 1), (5, 5, 1), (5, 6, 1)], "row long, col long, val long")
    got = sorted(tuple(r) for r in gd.grid_islands(cells, 0).collect())
    assert got == [(0, 1048576, 1), (1, 0, 1), (5, 5, 2)]


def test_long_chain_of_components(spark):
    edges = spark.range(3000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = gr.connected_components(edges, "src", "dst")
    assert got.where("comp != 0").count() == 0 and got.count() == 3001


def test_long_vectors_raise_instead_of_losing_bits(spark):
    df = spark.range(1).select(F.array(*[F.lit(1.0)] * 130).alias("e"))
    with pytest.raises(Exception, match="more than 64"):
        df.select(jn.sign_code(F.col("e"))).collect()


def test_csv_keeps_line_breaks_quotes_and_corrupt_rows(spark, tmp_path):
    from quern.sources.csv import read_csv, write_csv
    rows = [("1", 'two\nlines, "quoted"'), ("2", 'say "hi", ok'), ("3", "plain")]
    path = write_csv(spark.createDataFrame(rows, "a string, b string").coalesce(1), str(tmp_path / "out"))
    assert sorted(map(tuple, read_csv(spark, path).collect())) == rows
    (tmp_path / "bad.csv").write_text('a,b\n1,"x ""y"" z"\n2,3,4\n')
    got = {r.a: (r.b, r._bad) for r in read_csv(spark, str(tmp_path / "bad.csv"), corrupt_column="_bad").collect()}
    assert got["1"] == ('x "y" z', None) and got["2"][1] == "2,3,4"


def test_sample_does_not_depend_on_the_partitioning(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    one, two = (so.shuffle_sample(d, "k", 42, 30).collect() for d in (df, df.repartition(7)))
    assert one == two != so.shuffle_sample(df, "k", 43, 30).collect()


def test_stream_processors_over_many_batches():
    """Batches in and out of order against sweeps over all rows so far."""
    import numpy as np
    import pandas as pd

    from quern.streaming import operators as st

    class Value:
        v = None
        get = lambda self: self.v
        update = lambda self, v: setattr(self, "v", v)

    class Handle:
        getValueState = lambda self, *a: Value()

    rnd = random.Random(9)
    rows = [(i, rnd.randint(0, 60), rnd.randint(0, 60), rnd.choice([1.0, 2.0, 5.0, None])) for i in range(120)]
    batches = [sorted(rows[i:i + 17], key=lambda r: (r[1], r[0])) for i in range(0, 120, 17)]

    def feed(p, col):
        p.init(Handle())
        out = {}
        for b in batches:
            pdf = pd.DataFrame(b, columns=["id", "s", "e", "v"])
            got = next(iter(p.handleInputRows(("k",), iter([pdf]), None)))
            out.update(zip(got["id"], got[col]))
        return out
    order = [r for b in batches for r in b]
    overlap = feed(st.MaxOverlapProcessor(["k"], ["s", "id"], "id", "s", "e"), "max_overlap")
    recent = feed(st.RecentCountProcessor(["k"], "s", "id", 1000), "recent")
    mean = feed(st.MovingAverageProcessor(["k"], ["s", "id"], "id", "v", 4), "moving_avg")
    third = feed(st.KthLargestProcessor(["k"], ["s", "id"], "id", "e", 3), "kth_largest")
    for n, (i, s, _, _) in enumerate(order, 1):
        seen = order[:n]
        assert overlap[i] == max(sum(a <= x < b for _, a, b, _ in seen) for x in range(61))
        assert recent[i] == sum(a <= s for _, a, _, _ in seen)
        vals = [v for _, _, _, v in seen[-4:] if v is not None]
        assert mean[i] == pytest.approx(sum(vals) / len(vals)) if vals else np.isnan(mean[i])
        assert third[i] == sorted((b for _, _, b, _ in seen), reverse=True)[:3][-1]


def test_long_path_distances(spark):
    edges = [(i, i + 1, 2) for i in range(40)] + [(0, 20, 30), (0, 30, 100), (5, 3, 1), (40, 0, 1)]
    e = spark.createDataFrame(edges, "src long, dst long, w long")
    start = spark.createDataFrame([(0,)], "node long")
    hops, ways, cost = {0: 0}, {0: 1}, {n: (0 if n == 0 else 10 ** 9) for n in range(41)}
    for r in range(41):
        for a, b, _ in edges:
            if hops.get(a) == r and hops.get(b, r + 1) == r + 1:
                hops[b] = r + 1
                ways[b] = ways.get(b, 0) + ways[a]
        for a, b, w in edges:
            cost[b] = min(cost[b], cost[a] + w)
    assert {r.node: (r.dist, r.paths) for r in gr.bfs_distance(e, start).collect()} == {n: (hops[n], ways[n]) for n in hops}
    assert {r.node: r.dist for r in gr.shortest_paths(e, start).collect()} == cost


@pytest.mark.parametrize("lo,hi", [(None, None), (2, 6), (3, None), (None, 4)])
def test_gaps_between_bounds(spark, lo, hi):
    by = {None: [2, 5, 5, None], "a": [-3, 9], "b": [4], "c": [None], "d": [1, 2, 3, 4, 5, 6]}
    df = spark.createDataFrame([(k, v) for k, vs in by.items() for v in vs], "k string, v int")
    want = []
    for k, vs in by.items():
        inside = sorted({v for v in vs if v is not None and (lo is None or v >= lo) and (hi is None or v <= hi)})
        ends = ([lo - 1] if lo is not None else []) + inside + ([hi + 1] if hi is not None else [])
        want += [(k, a + 1, b - 1) for a, b in zip(ends, ends[1:]) if b - a > 1]
    got = [tuple(r) for r in sq.gaps(df, ["k"], "v", None if lo is None else F.lit(lo), None if hi is None else F.lit(hi)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_numeric_rejects(spark):
    df = spark.createDataFrame([("a", "1 2.5 x3 x3 e5"), ("a", None), (None, " 1e5 1e5.5 word 3. .5 . "), ("b", "")], "g string, t string")
    assert {tuple(r) for r in tj.numeric_rejects(df, "t", "g").collect()} == {("a", "x3", 2), ("a", "e5", 1), (None, "1e5.5", 1)}
    assert {tuple(r) for r in tj.numeric_audit(df, "t", "g").collect()} == {("a", 5, 2), (None, 6, 3)}


def test_banned_words_as_table(spark):
    df = spark.createDataFrame([("a b b",), ("c c c",), (None,)], "t string")
    banned = spark.createDataFrame([("c",)], "word string")
    assert [tuple(r) for r in ag.most_common_word(df, "t", banned).collect()] == [("b", 2)]


def test_near_duplicates_in_one_join(spark, series):
    rows, df = series
    for k, t in ((1, 0), (3, 0), (4, 1)):
        want = {}
        for key, vs in groups(rows).items():
            vs = [x[-1] if isinstance(x, tuple) else x for x in vs]
            want[key] = any(vs[i] is not None and vs[j] is not None and abs(vs[i] - vs[j]) <= t
                            for i in range(len(vs)) for j in range(i + 1, min(i + k, len(vs) - 1) + 1))
        assert {r.k: r.has_near_duplicate for r in jn.near_duplicates(df, ["k"], ["i"], "v", k, t).collect()} == want
    with pytest.raises(ValueError):
        jn.near_duplicates(df, ["k"], ["i"], "v", 0, 0)
