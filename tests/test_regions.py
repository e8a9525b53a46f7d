import random

from quern.operators import graph, grid


def regions(cells):
    """Sets of linked cells."""
    left, out = set(cells), []
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            r, c = todo.pop()
            seen.add((r, c))
            for x in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if x in left:
                    left.remove(x)
                    todo.append(x)
        out.append(seen)
    return out


def test_regions_match_a_walk(spark):
    rng = random.Random(2)
    cells = [(r, c, rng.choice([0, 0, 1, 1, None])) for r in range(14) for c in range(17)]
    df = spark.createDataFrame(cells, "row long, col long, val long")
    seeds = [(0, 0), (7, 8)]
    want = set()
    for s in seeds:
        v = next(x for r, c, x in cells if (r, c) == s)
        want |= next(g for g in regions({(r, c) for r, c, x in cells if x == v}) if s in g)
    got = grid.flooded_region(df, spark.createDataFrame(seeds, "row long, col long"))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    free = [g for g in regions({(r, c) for r, c, x in cells if x == 0}) if not any(r in (0, 13) or c in (0, 16) for r, c in g)]
    got = grid.enclosed_cells(df, 0)
    assert sorted(map(tuple, got.collect())) == sorted(x for g in free for x in g) and free


def test_islands_after_each_addition(spark):
    rng = random.Random(3)
    adds = [(rng.randrange(9), rng.randrange(9), t) for t in range(110)]
    df = spark.createDataFrame(adds, "row long, col long, t long")
    got = sorted(map(tuple, grid.islands_after_additions(df).collect()))
    assert got == [(t, len(regions({(r, c) for r, c, s in adds if s <= t}))) for t in range(110)]
    assert grid.islands_after_additions(df.limit(0)).collect() == []


def test_spanning_forest_weight(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60), rng.randrange(9)) for _ in range(150)]
    up = list(range(60))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    weight = n = 0
    for a, b, w in sorted(edges, key=lambda e: e[2]):
        if find(a) != find(b):
            up[find(a)] = find(b)
            weight, n = weight + w, n + 1
    got = graph.spanning_forest(spark.createDataFrame(edges, "src long, dst long, w long")).collect()
    assert (sum(r.w for r in got), len(got)) == (weight, n)
