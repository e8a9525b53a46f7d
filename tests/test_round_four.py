"""Work of the loops and joins grows with the input: pointer cycles, prefixes, distances, boxes, trees, streams."""

import random

from pyspark.sql import functions as F

from quern.operators import graph as gr
from quern.operators import joins as jn


def _count_writes(monkeypatch, *modules):
    """Rows written by ``materialize`` in the given modules."""
    rows = []
    for m in modules:
        def counted(df, write=m.materialize):
            out = write(df)
            rows.append(out.count())
            return out
        monkeypatch.setattr(m, "materialize", counted)
    return rows


def _walk(succ, x):
    """(on_cycle, tail, entry, label) of a node by walking."""
    seen, path, cur = {}, [], x
    while cur is not None and cur in succ and cur not in seen:
        seen[cur] = len(path)
        path.append(cur)
        cur = succ[cur]
    if cur is None or cur not in succ:
        return False, len(path) + (0 if cur is None else 1), None, None
    cycle = path[seen[cur]:]
    return x in cycle, seen[cur], cur, min(cycle)


def test_pointer_cycles_with_lost_and_repeated_rows(spark):
    rng = random.Random(5)
    succ = {x: rng.choice([rng.randrange(70), None, 900 + x]) if x % 9 == 0 else rng.randrange(60) for x in range(60)}
    rows = list(succ.items()) * 2  # every row twice
    df = spark.createDataFrame(rows, "node long, next long")
    got = sorted((r.node, r.on_cycle, r.tail, r.entry, r.cycle_label) for r in gr.pointer_cycles(df).collect())
    assert got == sorted((x, *_walk(succ, x)) for x in succ)


def test_pointer_cycles_writes_rows_in_proportion(spark, monkeypatch):
    from quern.plans import lifting
    written = _count_writes(monkeypatch, gr, lifting)
    n = 3000
    rng = random.Random(6)
    succ = {x: rng.randrange(n) for x in range(n)}
    df = spark.createDataFrame(list(succ.items()), "node long, next long")
    got = {r.node: (r.on_cycle, r.tail, r.entry, r.cycle_label) for r in gr.pointer_cycles(df).collect()}
    assert got == {x: _walk(succ, x) for x in succ}
    assert sum(written) < 14 * n


def test_prefix_lookup_broadcasts_probes_and_counts_words_once(spark):
    words = spark.createDataFrame([(w,) for w in ["view", "viewer", "vi", "view", "", None, "click", "\U0001d54fy"]], "w string")
    probes = spark.createDataFrame([(p,) for p in ["view", "vi", "view", None, "", "zzz", "\U0001d54f", "clicks"]], "p string")
    out = jn.prefix_lookup(words, "w", probes, "p")
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("view", 3, 2), ("vi", 4, 1), (None, 0, 0), ("", 0, 0), ("zzz", 0, 0), ("\U0001d54f", 1, 0), ("clicks", 0, 0)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" not in plan and "FileScan parquet" in plan, plan  # the probes' size is that of their files


def test_bfs_scans_the_visited_set(spark, monkeypatch):
    rows = [(i, i + 1) for i in range(6)] + [(0, 2), (3, 1), (5, 0), (2, 2)]
    seen_plans = []

    def watched(df, write=gr.materialize):
        seen_plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)
    monkeypatch.setattr(gr, "materialize", watched)
    got = gr.bfs_distance(spark.createDataFrame(rows, "src long, dst long"), spark.createDataFrame([(0,)], "node long"))
    assert {r.node: (r.dist, r.paths) for r in got.collect()} == {
        0: (0, 1), 1: (1, 1), 2: (1, 1), 3: (2, 1), 4: (3, 1), 5: (4, 1), 6: (5, 1)}
    assert not any("LeftAnti" in p for p in seen_plans)  # that side would have to be broadcast whole


def test_box_join_is_merged_by_cell(spark):
    boxes = spark.createDataFrame([(i, 3 * i, 0, 3 * i + 4 + i % 9, 5 + i % 3) for i in range(40)],
                                  "id long, x1 long, y1 long, x2 long, y2 long")
    out = jn.box_overlap_join(boxes, "id", "x1", "y1", "x2", "y2", cell=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    b = {i: (3 * i, 3 * i + 4 + i % 9) for i in range(40)}
    assert sorted((r.id_a, r.id_b) for r in out.collect()) == [
        (i, j) for i in b for j in b if i < j and b[j][0] < b[i][1] and b[i][0] < b[j][1]]


def test_streams_call_python_by_bucket_not_by_key(spark, tmp_path):
    """2,000 keys (one null) in two micro-batches: as many groups as buckets, states of all keys kept."""
    from quern.streaming import operators as st
    from quern.streaming.runner import file_stream, run_to_table

    rows = [(None if k == 7 else k, 10 * k + i, 5 * i, 5 * i + 7) for k in range(2000) for i in range(4)]
    feed = str(tmp_path / "feed")
    for part in (0, 1):
        some = [r for r in rows if r[1] % 10 // 2 == part]
        df = spark.createDataFrame(some, "k long, id long, s long, e long")
        df = df.withColumn("us", (F.col("s") + 1_000_000) * 1_000_000).withColumn("ts", F.timestamp_micros("us"))
        df.coalesce(1).write.mode("append").parquet(feed)
    s = file_stream(spark, feed)
    got = run_to_table(st.stream_max_overlap(s, ["k"], ["s", "id"], "id", "s", "e"), "o").collect()
    assert {(r.k, r.id): r.max_overlap for r in got} == {(r[0], r[1]): min(r[1] % 10 + 1, 2) for r in rows}
    limited = st.stream_rate_limit(s, ["k"], "us", "id", 10_000_000, lateness="1 day")
    assert "_bucket" in limited._jdf.queryExecution().analyzed().toString()
    assert {(r.k, r.id): (r.allowed, r.late) for r in run_to_table(limited, "l").collect()} == {
        (r[0], r[1]): (r[2] % 10 == 0, False) for r in rows}
