import random

from quern.operators import graph as gr


def slow(edges, sources, targets):
    dist, front = {s: 0 for s in sources}, set(sources)
    while front:
        new = {d for s, d in edges if s in front and d not in dist}
        dist.update({d: dist[next(iter(front))] + 1 for d in new})
        front = new
    onward = {(s, d) for s, d in edges if s in dist and dist.get(d) == dist[s] + 1}
    out, front = set(), set(targets)
    while front:
        step = {(s, d) for s, d in onward if d in front} - out
        out |= step
        front = {s for s, _ in step}
    return {(s, d, dist[d]) for s, d in out}


def test_edges_of_all_shortest_paths(spark):
    rng = random.Random(8)
    edges = {(rng.randrange(40), rng.randrange(40)) for _ in range(75)} | {(100, 101), (101, 102)}
    sources, targets = [0, 1], [1, 5, 9, 17, 33, 102, 999]
    df = spark.createDataFrame([*edges, (None, 3), (2, None)], "src long, dst long")
    one = lambda ids: spark.createDataFrame([(i,) for i in ids], "node long")
    got = {tuple(r) for r in gr.shortest_path_edges(df, one(sources), one(targets)).collect()}
    assert got == slow(edges, sources, targets) and got
    assert gr.shortest_path_edges(df, one(sources), one([])).count() == 0


def test_word_ladder(spark):
    words = spark.createDataFrame([(w,) for w in ["hit", "hot", "dot", "dog", "lot", "log", "cog"]], "w string")
    one = lambda w: spark.createDataFrame([(w,)], "node string")
    got = gr.shortest_path_edges(gr.one_letter_edges(words, "w"), one("hit"), one("cog"))
    assert {(r.src, r.dst) for r in got.collect()} == {("hit", "hot"), ("hot", "dot"), ("hot", "lot"), ("dot", "dog"),
                                                       ("lot", "log"), ("dog", "cog"), ("log", "cog")}
