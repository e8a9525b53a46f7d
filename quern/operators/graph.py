"""Graph operators on edge tables (survey 2.9).

Every algorithm is a driver loop of whole-table joins and aggregates; each
round is written to the shared folder (lineage cut) and the loop stops on a count of changed
rows.  Hub nodes are handled by partial aggregation and AQE skew joins; no
adjacency list is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lifting import ascend
from ..plans.loops import check_cap, discard, materialize, union_all


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", nodes: DataFrame | None = None,
                         initial: DataFrame | None = None) -> DataFrame:
    """(node, comp) with comp = smallest node id of the component.

    Contraction in a logarithmic number of rounds.  In a round every node
    points to its neighbour of least priority (itself, when its own is less),
    takes the pointer of that node, and nodes of one pointer become one node of
    the next round's edges.  Priorities are hashes of (node, round), so by
    expectation at most half of the nodes are kept each round whatever the
    order of the ids, and the rounds' tables shrink geometrically.  Labels
    come back by joining the rounds' maps from the last to the first.

    ``nodes`` adds isolated nodes (their own component).  ``initial`` (node,
    comp) continues from saved labels: saved components are single nodes from
    the start, so a batch of new edges only has to merge them; pass only the new
    edges.  Null ends and loops are left out."""
    one = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    ends = one.select(F.col("u").alias("node")).unionByName(one.select(F.col("v").alias("node")))
    if nodes is not None:
        ends = ends.unionByName(nodes.select(F.col(nodes.columns[0]).alias("node")).where("node IS NOT NULL"))
    if initial is not None:
        saved = materialize(initial.select(F.col("node").alias("member"), F.col("comp").alias("class")))
        one = _relabel(one, saved)
        known = ends.distinct().join(saved, F.col("node") == F.col("member"), "left").where(F.col("member").isNull())
        start = saved.unionByName(known.select(F.col("node").alias("member"), F.col("node").alias("class")))
    else:
        saved = None
        start = ends.distinct().select(F.col("node").alias("member"), F.col("node").alias("class"))
    e = materialize(_simple(one))
    maps: list[DataFrame] = []
    while e.count():
        m = materialize(_contract(e, maps[-1] if maps else None, len(maps)))
        smaller = materialize(_simple(_relabel(e, m)))
        discard(e)
        e = smaller
        maps.append(m)
    label = None
    for m in reversed(maps):
        least = m.groupBy("class").agg(F.min("least").alias("comp"))
        here = m.select("member", "class")
        if label is None:
            label = here.join(least, "class").select("member", "comp")
        else:
            later = label.select(F.col("member").alias("class"), F.col("comp").alias("_later"))
            label = (here.join(least, "class").join(later, "class", "left")
                     .select("member", F.coalesce("_later", "comp").alias("comp")))
    if label is None:
        out = start.select(F.col("member").alias("node"), F.col("class").alias("comp"))
    else:
        out = (start.join(label.select(F.col("member").alias("class"), "comp"), "class", "left")
               .select(F.col("member").alias("node"), F.coalesce("comp", "class").alias("comp")))
    out = materialize(out)
    discard(e, *maps, *([saved] if saved is not None else []))
    return out


def _simple(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, without loops."""
    return edges.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _relabel(edges: DataFrame, m: DataFrame) -> DataFrame:
    """Edges between the classes of their ends (an end without a row keeps its name)."""
    a = m.select(F.col("member").alias("_mu"), F.col("class").alias("_cu"))
    b = m.select(F.col("member").alias("_mv"), F.col("class").alias("_cv"))
    return (edges.join(a, edges["u"] == a["_mu"], "left").join(b, edges["v"] == b["_mv"], "left")
            .select(F.coalesce("_cu", "u").alias("u"), F.coalesce("_cv", "v").alias("v")))


def _contract(e: DataFrame, before: DataFrame | None, r: int) -> DataFrame:
    """(member, class, least): the class each node of ``e`` joins in round ``r``
    and the least id of the original nodes it stands for."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    rank = lambda c: F.struct(F.xxhash64(c, F.lit(r)).alias("h"), F.col(c).alias("x"))
    hook = both.groupBy("u").agg(F.min(rank("v")).alias("best"))
    hook = hook.select("u", F.least(rank("u"), F.col("best"))["x"].alias("p"))
    up = hook.select(F.col("u").alias("_p"), F.col("p").alias("class"))
    joined = hook.join(up, hook["p"] == up["_p"]).select(F.col("u").alias("member"), "class")
    if before is None:
        return joined.withColumn("least", F.col("member"))
    known = before.groupBy("class").agg(F.min("least").alias("least")).select(F.col("class").alias("_m"), "least")
    return joined.join(known, joined["member"] == known["_m"]).select("member", "class", "least")


def spanning_forest(edges: DataFrame, src: str = "src", dst: str = "dst", w: str = "w") -> DataFrame:
    """(src, dst, w) of a minimum spanning forest: in a round every component
    takes its least outgoing edge (ties by the ends) and the components these
    edges join become one; half of them at least go each round."""
    e = materialize(edges.where(F.col(src) != F.col(dst)).select(
        F.struct(F.col(w).alias("w"), F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")).alias("edge"))
        .distinct().select("edge", F.col("edge.u").alias("u"), F.col("edge.v").alias("v")))
    taken = []
    while e.count():
        ends = e.select("edge", "u", "v").unionByName(e.select("edge", F.col("v").alias("u"), F.col("u").alias("v")))
        best = ends.groupBy("u").agg(F.min(F.struct("edge", "v")).alias("b"))
        taken.append(materialize(best.select(F.col("b.edge").alias("edge"), "u", F.col("b.v").alias("v"))))
        m = connected_components(taken[-1], "u", "v").select(F.col("node").alias("member"), F.col("comp").alias("class"))
        a, b = (m.select(F.col("member").alias(f"_m{x}"), F.col("class").alias(f"_c{x}")) for x in "uv")
        left = materialize(e.join(a, F.col("u") == F.col("_mu")).join(b, F.col("v") == F.col("_mv")).where("_cu != _cv")
                           .select("edge", F.col("_cu").alias("u"), F.col("_cv").alias("v")))
        discard(e)
        e = left
    if not taken:
        return e.select(F.col("edge.u").alias(src), F.col("edge.v").alias(dst), F.col("edge.w").alias(w))
    return (union_all(taken).select("edge").distinct()
            .select(F.col("edge.u").alias(src), F.col("edge.v").alias(dst), F.col("edge.w").alias(w)))


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("comp").agg(F.count(F.lit(1)).alias("size"))


def one_letter_edges(words: DataFrame, word: str) -> DataFrame:
    """Edges between distinct words of equal length differing in one letter:
    each word is exploded to its wildcard patterns (one '*' per position),
    an equi-join on the pattern pairs them."""
    w = words.select(F.col(word).alias("w")).where(F.col("w").isNotNull()).distinct()
    pats = w.select("w", F.explode(F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.concat(
        F.substring("w", F.lit(1), i - 1), F.lit("*"), F.substring("w", i + 1, 1 << 30)))).alias("p"))
    a = pats.select(F.col("w").alias("src"), F.col("p").alias("pa"))
    b = pats.select(F.col("w").alias("dst"), F.col("p").alias("pb"))
    return a.join(b, (F.col("pa") == F.col("pb")) & (F.col("src") != F.col("dst"))).select("src", "dst").distinct()


def bfs_distance(edges: DataFrame, sources: DataFrame, src: str = "src", dst: str = "dst",
                 nodes: DataFrame | None = None) -> DataFrame:
    """Hop distance from the nearest source and the number of shortest paths
    (the all-shortest-paths count of the word ladder).  A round joins the
    frontier with the edges, then looks its new nodes up in the visited set;
    unreachable nodes get null.  Only a round's own nodes are small enough to be
    broadcast: the visited set is scanned, and over all rounds the driver sees a
    node about as often as a frontier reaches it."""
    e = materialize(edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).distinct())
    front = materialize(sources.select(F.col(sources.columns[0]).alias("node")).distinct()
                        .select("node", F.lit(0).cast("long").alias("dist"), F.lit(1).cast("long").alias("paths")))
    found, sizes = [front], [0]
    r = 0
    while True:
        r += 1
        seen = union_all(found)
        nxt = materialize(front.join(e, front["node"] == e["s"]).groupBy(F.col("d").alias("node"))
                          .agg(F.sum("paths").alias("paths")))
        old = seen.join(nxt.select("node"), "node", "left_semi").select("node", F.lit(None).cast("long").alias("paths"))
        front = materialize(nxt.withColumn("_new", F.lit(True)).unionByName(old.withColumn("_new", F.lit(False)))
                            .groupBy("node").agg(F.sum("paths").alias("paths"), F.bool_and("_new").alias("_new")).where("_new")
                            .select("node", F.lit(r).cast("long").alias("dist"), "paths"))
        discard(nxt)
        n = front.count()
        if n == 0:
            break
        found.append(front)
        sizes.append(n)
        # Visited rounds are merged by size, so a long path keeps few tables and a row is rewritten log n times.
        k = len(sizes) - 1
        while k and sizes[k - 1] <= sum(sizes[k:]):
            k -= 1
        if len(sizes) - k > 2:
            found[k:], sizes[k:] = [materialize(union_all(found[k:]))], [sum(sizes[k:])]
    if nodes is None:
        nodes = e.select(F.col("s").alias("node")).unionByName(e.select(F.col("d").alias("node")))
    allnodes = nodes.select(F.col(nodes.columns[0]).alias("node")).unionByName(seen.select("node")).distinct()
    return allnodes.join(seen, "node", "left")


def shortest_path_edges(edges: DataFrame, sources: DataFrame, targets: DataFrame, src: str = "src",
                        dst: str = "dst") -> DataFrame:
    """(src, dst, dist) of every edge on some shortest hop path from the nearest
    source to a target, ``dist`` being the hops to ``dst``: the whole set of
    shortest paths (the word ladder's listing) as one graph, without writing
    out paths, whose number may grow exponentially.  Targets out of reach and
    targets that are sources add no edge.

    Edges that go one layer on are written by layer; a walk back from the
    deepest target layer joins one layer a round, so each edge is read once."""
    e = materialize(edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).distinct())
    dist = materialize(bfs_distance(e, sources, "s", "d").where("dist IS NOT NULL").select("node", "dist"))
    lo, hi = (dist.select(F.col("node").alias(f"_n{x}"), F.col("dist").alias(f"_{x}")) for x in "sd")
    onward = materialize(e.join(lo, F.col("s") == F.col("_ns")).join(hi, F.col("d") == F.col("_nd"))
                         .where(F.col("_d") == F.col("_s") + 1).select("s", "d", F.col("_d").alias("dist"))
                         .repartitionByRange("dist", "d").sortWithinPartitions("dist"))
    ends = materialize(dist.join(targets.select(F.col(targets.columns[0]).alias("node")).distinct(), "node", "left_semi"))
    kept: list[DataFrame] = []
    for layer in range(ends.agg(F.max("dist")).first()[0] or 0, 0, -1):
        front = ends.where(F.col("dist") == layer).select("node")
        if kept:
            front = front.unionByName(kept[-1].select(F.col("s").alias("node"))).distinct()
        kept.append(materialize(onward.where(F.col("dist") == layer).join(front, F.col("d") == F.col("node"), "left_semi")))
    out = union_all(kept) if kept else onward.limit(0)
    return out.select(F.col("s").alias(src), F.col("d").alias(dst), "dist")


def shortest_paths(edges: DataFrame, sources: DataFrame, src: str = "src", dst: str = "dst", w: str = "w",
                   max_rounds: int | None = None) -> DataFrame:
    """Least total weight from the sources (non-negative or not: Bellman-Ford
    rounds of join + min until nothing improves; the cap is the node count).
    A round follows the edges of the nodes that the last one improved."""
    e = materialize(edges.groupBy(F.col(src).alias("s"), F.col(dst).alias("d")).agg(F.min(w).alias("w")))
    dist = materialize(sources.select(F.col(sources.columns[0]).alias("node")).distinct()
                       .select("node", F.lit(0).cast("long").alias("dist")))
    cap = max_rounds or (e.select(F.col("s").alias("n")).union(e.select(F.col("d").alias("n"))).distinct().count() + 1)
    front = dist
    r = 0
    while True:
        check_cap(r, cap, "shortest_paths")
        r += 1
        cand = front.join(e, front["node"] == e["s"]).groupBy(F.col("d").alias("node")).agg(
            F.min(F.col("dist") + F.col("w")).alias("cand"))
        new = materialize(dist.join(cand, "node", "full").select(
            "node", F.least("dist", "cand").alias("dist"),
            (F.col("dist").isNull() | (F.col("cand") < F.col("dist"))).alias("_better")))
        changed = new.where("_better").count()
        dist = new.select("node", "dist")
        if changed == 0:
            return dist
        front = new.where("_better").select("node", "dist")


def delay_answer(dist: DataFrame, nodes: DataFrame) -> DataFrame:
    """Network delay: the largest distance, or -1 if some node is unreachable."""
    n = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct()
    j = n.join(dist, "node", "left")
    return j.agg(F.when(F.count(F.when(F.col("dist").isNull(), 1)) > 0, F.lit(-1).cast("long"))
                 .otherwise(F.max("dist")).alias("delay"))


def bounded_hop_paths(edges: DataFrame, sources: DataFrame, k: int, src: str = "src", dst: str = "dst",
                      w: str = "w") -> DataFrame:
    """Cheapest cost to every node using at most k stops (k + 1 edges); each
    round reads only the previous round's costs."""
    e = materialize(edges.groupBy(F.col(src).alias("s"), F.col(dst).alias("d")).agg(F.min(w).alias("w")))
    best = materialize(sources.select(F.col(sources.columns[0]).alias("node")).distinct()
                       .select("node", F.lit(0).cast("long").alias("cost")))
    for _ in range(k + 1):
        cand = best.join(e, best["node"] == e["s"]).groupBy(F.col("d").alias("node")).agg(
            F.min(F.col("cost") + F.col("w")).alias("cand"))
        best = materialize(best.join(cand, "node", "full").select("node", F.least("cost", "cand").alias("cost")))
    return best


def topo_layers(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Layer of each node (peeling of in-degree 0 nodes round by round);
    nodes never peeled are on or behind a cycle (layer null, in_cycle true)."""
    e = materialize(edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).distinct())
    nodes = materialize(e.select(F.col("s").alias("node")).unionByName(e.select(F.col("d").alias("node"))).distinct())
    left_nodes, left_edges = nodes, e
    done = []
    r = 0
    while True:
        zero = materialize(left_nodes.join(left_edges.select(F.col("d").alias("node")).distinct(), "node", "left_anti")
                           .withColumn("layer", F.lit(r).cast("long")))
        if zero.count() == 0:
            break
        done.append(zero)
        left_nodes = materialize(left_nodes.join(zero.select("node"), "node", "left_anti"))
        left_edges = materialize(left_edges.join(zero.select(F.col("node").alias("s")), "s", "left_anti"))
        r += 1
    out = nodes.join(union_all(done), "node", "left") if done else nodes.withColumn("layer", F.lit(None).cast("long"))
    return out.withColumn("in_cycle", F.col("layer").isNull())


def cycle_labels(f: DataFrame) -> DataFrame:
    """(x, lab) for the nodes of a one-successor table (x, y) that lie on a
    cycle, ``lab`` being the least node of that cycle.

    Round k holds the steps of length 2^k of the nodes that 2^k - 1 steps can
    reach, which shrink towards the cycles; when every node left is reached by
    one that is left, the steps permute them, so all are on cycles.  The least
    node of the stretches walked is then doubled until it falls no more, which
    takes the logarithm of the longest cycle."""
    g = materialize(f.where("x IS NOT NULL AND y IS NOT NULL").select("x", "y", F.least("x", "y").alias("lab")))

    def twice(g: DataFrame) -> DataFrame:
        q = g.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("lab").alias("_lab"))
        return materialize(g.join(q, g["y"] == q["_x"]).select(
            "x", F.col("_y").alias("y"), F.least("lab", "_lab").alias("lab"), (F.col("_lab") < F.col("lab")).alias("_fell")))

    n = g.count()
    while True:
        kept = materialize(g.join(g.select(F.col("y").alias("x")).distinct(), "x", "left_semi"))
        m = kept.count()
        discard(g)
        if m == n:
            break
        g = twice(kept)
        discard(kept)
        n = g.count()
    while True:
        g = twice(kept)
        discard(kept)
        if g.where("_fell").isEmpty():
            return g.select("x", "lab")
        kept = g


def pointer_cycles(nxt: DataFrame, node: str = "node", succ: str = "next") -> DataFrame:
    """For a one-successor table: on_cycle, tail (steps to reach a cycle),
    entry (first cycle node reached) and cycle label (least node of that
    cycle).  Cycles by doubling over the nodes that long walks still reach; the
    other nodes climb to their cycle by pointer doubling, in rounds of the
    logarithm of the longest tail.  Rows given twice count once.

    A walk that runs off the table has no entry and no label; its tail counts
    the steps to the last node named, and one."""
    f = materialize(nxt.select(F.col(node).alias("x"), F.col(succ).alias("y")).distinct())
    cyclic = cycle_labels(f)
    on = cyclic.select(F.col("x").alias("_on"))
    known = f.select(F.col("x").alias("_known")).where("_known IS NOT NULL").distinct()
    off = (f.join(on, f["x"] == on["_on"], "left_anti").join(on, F.col("y") == F.col("_on"), "left")
           .join(known, F.col("y") == F.col("_known"), "left"))
    lost = F.col("x").isNull() | F.col("y").isNull()  # the walk ends here
    inner = ~lost & F.col("_on").isNull() & F.col("_known").isNotNull()
    start = off.select(F.col("x").alias("id"), F.when(inner, F.col("y")).alias("up"),
                       F.when(~lost & F.col("_known").isNull(), 2).otherwise(1).cast("long").alias("tail"),
                       F.when(F.col("x").isNotNull(), F.col("_on")).alias("entry"))
    climbed, _ = ascend(start, {"tail": lambda low, high: low("tail") + high("tail"), "entry": lambda low, high: high("entry")})
    labels = cyclic.select(F.col("x").alias("_e"), F.col("lab").alias("cycle_label"))
    tails = climbed.join(labels, F.col("entry") == F.col("_e"), "left").select(
        F.col("id").alias(node), F.lit(False).alias("on_cycle"), "tail", "entry", "cycle_label")
    return tails.unionByName(cyclic.select(F.col("x").alias(node), F.lit(True).alias("on_cycle"), F.lit(0).cast("long").alias("tail"),
                                           F.col("x").alias("entry"), F.col("lab").alias("cycle_label")))


def chain_rank(nxt: DataFrame, node: str = "node", succ: str = "next", max_rounds: int = 64,
               rotate: int = 2) -> DataFrame:
    """Rank of every row in its linked chain (list ranking by pointer
    doubling), the chain's tail, its length and reorder keys: reversed,
    odd/even, pairwise swapped and folded (first, last, second, ...)."""
    # the tail points to itself with distance 0, so doubling stops there
    s = materialize(nxt.select(F.col(node).alias("x"), F.coalesce(F.col(succ), F.col(node)).alias("y"),
                               F.when(F.col(succ).isNull(), 0).otherwise(1).cast("long").alias("d")))
    r = 0
    while True:
        check_cap(r, max_rounds, "chain_rank")
        r += 1
        q = s.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("d").alias("_d"))
        s2 = materialize(s.join(q, s["y"] == q["_x"], "left").select(
            "x", F.coalesce(F.col("_y"), F.col("y")).alias("y"),
            (F.col("d") + F.when(F.col("y") != F.col("x"), F.coalesce("_d", F.lit(0))).otherwise(0)).alias("d"),
            (F.col("_y").isNotNull() & (F.col("_y") != F.col("y"))).alias("_moved")))
        s = s2.select("x", "y", "d")
        if s2.where("_moved").count() == 0:
            break
    # y is now the tail; d = number of rows after x
    t = s.select(F.col("x").alias(node), F.col("y").alias("tail"), F.col("d").alias("after"))
    lengths = t.groupBy("tail").agg(F.max("after").alias("_m")).select("tail", (F.col("_m") + 1).alias("length"))
    t = t.join(lengths, "tail")
    rank = F.col("length") - F.col("after")
    n = F.col("length")
    half = F.ceil(n / 2)
    return t.select(node, "tail", "length", rank.alias("rank"),
                    (n - rank + 1).alias("reversed_pos"),
                    F.when(rank % 2 == 1, (rank + 1) / 2).otherwise(F.ceil(n / 2) + rank / 2).cast("long").alias("odd_even_pos"),
                    F.when((rank % 2 == 1) & (rank < n), rank + 1).when(rank % 2 == 0, rank - 1)
                    .otherwise(rank).cast("long").alias("swapped_pos"),
                    F.when(rank <= half, 2 * rank - 1).otherwise(2 * (n - rank + 1)).cast("long").alias("folded_pos"),
                    (rank == F.floor(n / 2) + 1).alias("is_middle"),
                    (F.pmod(rank - 1 + F.lit(rotate), n) + 1).cast("long").alias("rotated_pos"))


def circular_loops(steps: DataFrame, node: str = "node", step: str = "step") -> DataFrame:
    """Array-loop form over positions 0..n-1 with moves ``step`` (next =
    (node + step) mod n): every cycle with its length and whether it is a
    valid loop (length > 1, all moves in one direction)."""
    n = steps.select(F.count(F.lit(1))).scalar()
    f = steps.select(F.col(node).alias("node"), F.pmod(F.col(node) + F.col(step), n).alias("next"),
                     F.signum(step).alias("_sign")).distinct()
    cyc = pointer_cycles(f.select("node", "next")).where("on_cycle")
    j = cyc.join(f.select("node", "_sign"), "node")
    g = j.groupBy(F.col("cycle_label").alias("cycle")).agg(
        F.count(F.lit(1)).alias("length"), F.min("_sign").alias("_lo"), F.max("_sign").alias("_hi"))
    return g.select("cycle", "length", ((F.col("length") > 1) & (F.col("_lo") == F.col("_hi"))
                                        & (F.col("_lo") != 0)).alias("valid"))
