"""Hierarchy operators on a parent-child table ``(id, parent, side, val)``
(survey 2.10).

``tree_paths`` climbs from every node to its root by pointer doubling
(``plans/lifting.py``): level, root sum and the like in log2(depth) rounds of
one join, and the pointers of each round.  Subtree values are folds over the
same pointers, preorder positions are root sums of the sizes to the left, and
orders, neighbours and stabbing counts are skew-safe scans over positions.  A
path is written out only where it is the result (``root_paths``,
``merge_trees``, ``outline_paths``); no row holds its ancestors or a subtree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lifting import ancestor_pairs, ascend, descend
from ..plans.loops import materialize
from ..plans.scan import Agg, ordered_scan, previous, reusable, row_index
from .sequences import running_sum


@dataclass
class Tree:
    """Rows (id, parent, side, val, level, psum, run, rights, digits; ``code``
    when asked for), the lifts, and the preorder once it was needed."""
    rows: DataFrame
    lifts: list[DataFrame]
    order: DataFrame | None = field(default=None, repr=False)


def _rows(tree: Tree | DataFrame) -> DataFrame:
    return tree.rows if isinstance(tree, Tree) else tree


def binary_heap_tree(df: DataFrame, key: str, val: Column) -> DataFrame:
    """Tree with parent = key div 2 (a key that is its own parent is a root),
    side L for even keys and R for odd ones."""
    parent = F.floor(F.col(key) / 2).cast("long")
    return df.select(F.col(key).cast("long").alias("id"),
                     F.when(parent != F.col(key), parent).alias("parent"),
                     F.when(F.col(key) % 2 == 0, "L").otherwise("R").alias("side"),
                     val.cast("long").alias("val"))


def _number(low, high) -> Column:
    """Digits of the upper part before those of the lower; null beyond 38."""
    power = F.expr("CASE WHEN length < 38 THEN CAST(rpad('1', CAST(length AS INT) + 1, '0') AS DECIMAL(38,0)) END")
    return (F.when(high("number") == 0, low("number"))
            .otherwise(F.try_add(F.try_multiply(high("number"), power), low("number")).cast("decimal(38,0)")))


def tree_paths(nodes: DataFrame, codes: bool = False) -> Tree:
    """Every node with its level, root-to-node sum, the length of the +1 run
    ending at it, the number of right steps on its path and the number its
    path's digits spell (as text; null when it does not fit 38 digits); with
    ``codes`` also the path code (``0`` left, ``1`` right), as long as the path.

    Ids are unique; a node whose parent is null or has no row is a root; rows
    on a cycle have no root and are left out, as is a cycle's whole subtree.  A
    null value makes the sums below it null."""
    n = reusable(nodes.select("id", "parent", "side", "val"))
    above = n.select(F.col("id").alias("up"), F.col("val").alias("_pval"))
    inner = n.where("parent IS NOT NULL").join(above, F.col("parent") == F.col("up"), "left")
    top = n.where("parent IS NULL").select("*", F.lit(None).cast(n.schema["id"].dataType).alias("up"),
                                           F.lit(None).cast(n.schema["val"].dataType).alias("_pval"))
    linked = F.coalesce(F.col("val") == F.col("_pval") + 1, F.lit(False))
    right = F.when(F.col("up").isNull() | F.coalesce(F.col("side") == "L", F.lit(False)), 0).otherwise(1)
    step = F.when(F.col("up").isNull(), "").when(F.col("side") == "L", "0").otherwise("1")
    start = inner.unionByName(top).select(
        "id", "parent", "side", "val", "up", F.lit(1).cast("long").alias("length"), F.col("val").cast("long").alias("psum"),
        linked.cast("long").alias("links"), linked.alias("whole"), right.cast("long").alias("rights"),
        F.pmod("val", F.lit(10)).cast("decimal(38,0)").alias("number"), *([step.alias("code")] if codes else []))
    add = lambda c: lambda low, high: low(c) + high(c)
    combine = {"length": add("length"), "psum": add("psum"), "rights": add("rights"), "number": _number,
               "links": lambda low, high: low("links") + F.when(low("whole"), high("links")).otherwise(0),
               "whole": lambda low, high: low("whole") & high("whole")}
    if codes:
        combine["code"] = lambda low, high: F.concat(high("code"), low("code"))
    rows, lifts = ascend(start, combine)
    rows = rows.select("id", "parent", "side", "val", (F.col("length") - 1).alias("level"), "psum",
                       (F.col("links") + 1).alias("run"), "rights", F.col("number").cast("string").alias("digits"),
                       *(["code"] if codes else []))
    return Tree(rows, lifts)


def preorder(tree: Tree) -> DataFrame:
    """(id, val, side, parent, level, psum, run, rights, size, n_left, n_right,
    left_size, pre_pos): subtree sizes by a fold; a node's preorder position is
    the sum, over its path, of one and the sizes of earlier siblings.  Siblings
    go left before right, then by id; roots by id."""
    if tree.order is not None:
        return tree.order
    sizes = descend(tree.rows.withColumn("size", F.lit(1).cast("long")), tree.lifts, {"size": F.sum})
    cols = ["id", "val", "side", "parent", "level", "psum", "run", "rights"]
    rows = tree.rows.select(cols).join(sizes, "id")
    kids = rows.where("level > 0").groupBy(F.col("parent").alias("_p")).agg(
        F.count(F.when(F.col("side") == "L", 1)).alias("n_left"), F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(F.col("side") == "L", F.col("size"))).alias("_ls"))
    rows = rows.join(kids, rows["id"] == kids["_p"], "left").select(
        *cols, "size", F.coalesce("n_left", F.lit(0)).alias("n_left"),
        (F.coalesce("_n", F.lit(0)) - F.coalesce("n_left", F.lit(0))).alias("n_right"),
        F.coalesce("_ls", F.lit(0)).alias("left_size"))
    rows = rows.withColumn("up", F.when(F.col("level") > 0, F.col("parent")))
    rows = rows.withColumn("_right", F.when(F.col("level") == 0, 0).when(F.col("side") == "L", 0).otherwise(1))
    before = running_sum(rows, ["up"], ["_right", "id"], "size", "_upto")
    start = before.select(*cols, "size", "n_left", "n_right", "left_size", "up",
                          (F.col("_upto") - F.col("size") + 1).alias("pre_pos"))
    tree.order = ascend(start, {"pre_pos": lambda low, high: low("pre_pos") + high("pre_pos")},
                        rounds=len(tree.lifts))[0]
    return tree.order


def leaves(tree: Tree | DataFrame) -> DataFrame:
    paths = _rows(tree)
    kids = paths.select(F.col("parent").alias("_pp")).where(F.col("_pp").isNotNull()).distinct()
    return paths.join(kids, paths["id"] == kids["_pp"], "left_anti")


def tree_levels(tree: Tree) -> DataFrame:
    """Per node: level, position in its level (left to right), zigzag
    position (odd levels right to left) and the right neighbour in the level."""
    p = preorder(tree).select("id", "level", "pre_pos")
    r = row_index(p, ["level"], ["pre_pos"], name="pos_in_level")
    r = previous(r, ["level"], ["pre_pos"], ["id"], prefix="_nx_", descending=True)
    sizes = p.groupBy("level").agg(F.count(F.lit(1)).alias("_size"))
    r = r.join(sizes, "level")
    zig = F.when(F.col("level") % 2 == 1, F.col("_size") - F.col("pos_in_level") + 1).otherwise(F.col("pos_in_level"))
    return r.select("id", "level", "pos_in_level", zig.alias("zigzag_pos"), F.col("_nx_id").alias("right_neighbour"))


def tree_summary(tree: Tree | DataFrame) -> DataFrame:
    """Max depth (levels), least leaf depth, depth-weighted sum, sum of left
    leaves and the sum of the root-to-leaf digit numbers (null when any of
    them does not fit 38 digits)."""
    lv = leaves(tree)
    number = F.expr("try_cast(digits AS DECIMAL(38,0))")
    a = _rows(tree).agg((F.max("level") + 1).alias("max_depth"),
                  F.sum(F.col("val") * (F.col("level") + 1)).alias("weighted_sum"))
    b = lv.agg((F.min("level") + 1).alias("min_leaf_depth"),
               F.coalesce(F.sum(F.when(F.col("side") == "L", F.col("val"))), F.lit(0)).alias("left_leaf_sum"),
               F.when(F.count(F.lit(1)) == F.count(number), F.sum(number)).alias("digit_sum"))
    return a.unionByName(b, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ["max_depth", "weighted_sum", "min_leaf_depth", "left_leaf_sum", "digit_sum"]])


def root_paths(tree: Tree, target: int) -> DataFrame:
    """Root-to-leaf paths: text, sum, whether the sum hits ``target``, and the
    path's digits (text, and the number where it fits 64 bits).  The rows of a
    leaf's ancestors are gathered, as the result holds them in one text; a null
    value makes the texts null."""
    lv = leaves(tree).select("id", F.col("psum").alias("path_sum"))
    own = tree.rows.select(F.col("id").alias("_n"), "val")
    pairs = ancestor_pairs(lv, tree.lifts)
    steps = pairs.join(own, F.col("ancestor") == F.col("_n")).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("dist")).alias("at"), "val"))).alias("steps"),
        (F.count("val") == F.count(F.lit(1))).alias("full"))
    digit = lambda s: F.pmod(s["val"], F.lit(10)).cast("string")
    text = steps.select("id", F.when(F.col("full"), F.array_join(F.transform("steps", lambda s: s["val"].cast("string")), "->"))
                        .alias("path_text"),
                        F.when(F.col("full"), F.array_join(F.transform("steps", digit), "")).alias("digits"))
    return lv.join(text, "id").select("id", "path_text", "path_sum", (F.col("path_sum") == target).alias("hits_target"),
                                      F.col("digits").alias("digit_text"),
                                      F.expr("try_cast(digits AS BIGINT)").alias("digit_number"))


def segment_paths(tree: Tree, k: int) -> DataFrame:
    """Per node: downward paths ending at it with sum k, and the length of the
    +1 run ending at it.

    A path from ancestor a has sum k when the root sum before a is the node's
    less k.  Ancestors are the nodes whose preorder range holds the node's
    position, so the count is a running sum, per root sum, of +1 where a range
    with it opens and -1 behind its end."""
    p = preorder(tree)
    before = F.col("psum") - F.col("val")
    none = F.lit(None).cast(p.schema["id"].dataType)
    event = lambda pos, delta: p.where(before.isNotNull()).select(
        none.alias("id"), before.alias("total"), pos.alias("pos"), F.lit(0).alias("kind"),
        F.lit(delta).cast("long").alias("delta"), F.lit(None).cast("long").alias("run"))
    ask = p.select("id", (F.col("psum") - k).alias("total"), F.col("pre_pos").alias("pos"), F.lit(1).alias("kind"),
                   F.lit(0).cast("long").alias("delta"), "run")
    events = event(F.col("pre_pos"), 1).unionByName(event(F.col("pre_pos") + F.col("size"), -1)).unionByName(ask)
    counted = running_sum(events, ["total"], ["pos", "kind"], "delta", "n_paths")
    return counted.where("kind = 1").select("id", "n_paths", "run")


def subtree_stats(tree: Tree) -> DataFrame:
    """Per node: height (edges to the deepest leaf), balanced (child heights
    differ by at most 1, a missing child counts -1), diameter through the
    node, best gain (best downward path sum starting at the node) and the best
    path sum through the node.

    Two folds over the subtree: height = max descendant level - level and gain
    = max descendant root sum - root sum + value (the best path from the node
    down to any descendant); one join then brings each node its two children's
    values."""
    rows = tree.rows.select("id", "parent", "side", "val", "level", "psum")
    down = descend(rows.select("id", F.col("level").alias("_maxlvl"), F.col("psum").alias("_maxsum")), tree.lifts,
                   {"_maxlvl": F.max, "_maxsum": F.max})
    stats = rows.join(down, "id").select("id", "parent", "side", "val", (F.col("_maxlvl") - F.col("level")).alias("height"),
                                         (F.col("_maxsum") - F.col("psum") + F.col("val")).alias("gain"))
    kids = stats.where("parent IS NOT NULL").groupBy(F.col("parent").alias("_p")).agg(
        F.max(F.when(F.col("side") == "L", F.col("height"))).alias("_hl"),
        F.max(F.when(F.col("side") == "R", F.col("height"))).alias("_hr"),
        F.max(F.when(F.col("side") == "L", F.col("gain"))).alias("_gl"),
        F.max(F.when(F.col("side") == "R", F.col("gain"))).alias("_gr"))
    j = stats.join(kids, stats["id"] == kids["_p"], "left")
    hl, hr = F.coalesce("_hl", F.lit(-1)), F.coalesce("_hr", F.lit(-1))
    gl, gr_ = F.greatest(F.coalesce("_gl", F.lit(0)), F.lit(0)), F.greatest(F.coalesce("_gr", F.lit(0)), F.lit(0))
    return j.select("id", "height", (F.abs(hl - hr) <= 1).alias("balanced"), (hl + hr + 2).alias("diameter_through"),
                    "gain", (F.col("val") + gl + gr_).alias("best_path_through"))


def lowest_common_ancestor(tree: Tree, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Deepest shared ancestor of each pair (a node is its own ancestor); null
    for nodes of two trees; pairs with a node that has no row are left out.

    All pairs at once over the lifts: the deeper node climbs by the bits of the
    difference in level, then both climb by falling powers of two as long as
    their ancestors differ."""
    lv = tree.rows.select(F.col("id").alias("_n"), F.col("level").alias("_l"))
    la, lb = (lv.select(F.col("_n").alias(f"_{x}"), F.col("_l").alias(f"_l{x}")) for x in "ab")
    row = pairs.select(F.struct(*[F.col(c) for c in pairs.columns]).alias("_row"), F.col(a).alias("_va"), F.col(b).alias("_vb"))
    j = row.join(la, F.col("_va") == F.col("_a")).join(lb, F.col("_vb") == F.col("_b"))
    deeper = F.col("_la") >= F.col("_lb")
    j = materialize(j.select("_row", F.when(deeper, F.col("_a")).otherwise(F.col("_b")).alias("_x"),
                             F.when(deeper, F.col("_b")).otherwise(F.col("_a")).alias("_y"),
                             F.abs(F.col("_la") - F.col("_lb")).alias("_gap")))

    def lift(k: int, name: str) -> DataFrame:
        return tree.lifts[k].select(F.col("id").alias(f"_from{name}"), F.col("up").alias(f"_up{name}"))

    for k in range(len(tree.lifts)):
        bit = F.col("_gap").bitwiseAND(F.lit(1 << k).cast("long")) != 0
        climbed = j.where(bit).join(lift(k, "x"), F.col("_x") == F.col("_fromx"))
        j = materialize(j.where(~bit).unionByName(climbed.select("_row", F.col("_upx").alias("_x"), "_y", "_gap")))
    for k in reversed(range(len(tree.lifts))):
        up = j.join(lift(k, "x"), F.col("_x") == F.col("_fromx"), "left").join(lift(k, "y"), F.col("_y") == F.col("_fromy"), "left")
        apart = F.coalesce(F.col("_upx") != F.col("_upy"), F.lit(False))
        j = materialize(up.select("_row", F.when(apart, F.col("_upx")).otherwise(F.col("_x")).alias("_x"),
                                  F.when(apart, F.col("_upy")).otherwise(F.col("_y")).alias("_y")))
    if tree.lifts:
        j = j.join(lift(0, "x"), F.col("_x") == F.col("_fromx"), "left")
        lca = F.when(F.col("_x") == F.col("_y"), F.col("_x")).otherwise(F.col("_upx"))
    else:
        lca = F.when(F.col("_x") == F.col("_y"), F.col("_x"))
    return j.select("_row.*", lca.alias("lca"))


def leaf_order(tree: Tree) -> DataFrame:
    """Leaves left to right with their position."""
    lv = preorder(tree).where("size = 1").select("id", "val", "side", "pre_pos")
    return row_index(lv, [], ["pre_pos"], name="leaf_pos").drop("pre_pos")


def leaf_similar(tree_a: Tree, tree_b: Tree) -> DataFrame:
    """Do two trees have the same leaf value sequence?  Positions joined."""
    a = leaf_order(tree_a).select("leaf_pos", F.col("val").alias("va"))
    b = leaf_order(tree_b).select("leaf_pos", F.col("val").alias("vb"))
    j = a.join(b, "leaf_pos", "full")
    return j.agg(F.coalesce(F.bool_and(F.col("va").eqNullSafe(F.col("vb"))), F.lit(True)).alias("similar"),
                 F.count("va").alias("n_leaves_a"), F.count("vb").alias("n_leaves_b"),
                 F.min(F.when(~F.col("va").eqNullSafe(F.col("vb")), F.col("leaf_pos"))).alias("first_difference"))


def traversal_order(tree: Tree) -> DataFrame:
    """Pre-, in- and post-order positions.  Before a node in post-order come
    the nodes before it in preorder that are not its ancestors, and its
    subtree; in in-order the former, its left subtree, and the ancestors in
    whose right subtree it lies."""
    apart = F.col("pre_pos") - 1 - F.col("level")
    return preorder(tree).select("id", "val", "pre_pos", (apart + F.col("left_size") + F.col("rights") + 1).alias("in_pos"),
                                 (apart + F.col("size")).alias("post_pos"))


def is_search_tree(order: DataFrame) -> DataFrame:
    """In-order values strictly rising?"""
    p = previous(order.select("id", "val", "in_pos"), [], ["in_pos"], ["val"], prefix="_pv_")
    return p.agg(F.coalesce(F.bool_and(F.col("_pv_val").isNull() | (F.col("val") > F.col("_pv_val"))),
                            F.lit(True)).alias("is_search_tree"))


def _same_subtrees(a: DataFrame, b: DataFrame) -> DataFrame:
    """(tree, pos, size, head, tail): equal (size, head, tail) exactly where two
    subtrees are equal.

    A subtree is the stretch of ``size`` tokens (value, children left and
    right) from its preorder position.  Round k names every stretch of 2^k
    tokens by the least position at which the same pair of half-size names
    stands; a stretch of any length is the two longest named ones at its start
    and its end.  Names stand for equal tokens, not for equal hashes."""
    tokens = lambda t, tag: t.select(F.lit(tag).alias("tree"), F.col("pre_pos").alias("pos"), "size",
                                     F.struct("val", "n_left", "n_right").alias("token"))
    both = materialize(tokens(a, "a").unionByName(tokens(b, "b")))
    place = F.struct("tree", "pos")

    def name(parts: DataFrame, cols: list[str]) -> DataFrame:
        first = parts.groupBy(*cols).agg(F.min(place).alias("name"))
        left = parts.select(*[F.col(c).alias(f"_{c}") for c in cols], "tree", "pos")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]
        return materialize(left.join(first, same).select("tree", "pos", "name"))

    named, length, found = name(both, ["token"]), 1, []
    largest = both.agg(F.max("size")).first()[0] or 0
    while length <= largest:
        ends = both.where((F.col("size") >= length) & (F.col("size") < 2 * length)).select("tree", "pos", "size")
        tail = named.select("tree", F.col("pos").alias("_end"), F.col("name").alias("tail"))
        found.append(ends.join(named.withColumnRenamed("name", "head"), ["tree", "pos"])
                     .withColumn("_end", F.col("pos") + F.col("size") - length).join(tail, ["tree", "_end"]).drop("_end"))
        if 2 * length > largest:
            break
        second = named.select("tree", (F.col("pos") - length).alias("pos"), F.col("name").alias("second"))
        named = name(named.withColumnRenamed("name", "first").join(second, ["tree", "pos"]), ["first", "second"])
        length *= 2
    if not found:
        return both.select("tree", "pos", "size", place.alias("head"), place.alias("tail"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return materialize(out)


_PRIME = 2**31 - 1  # products of two residues fit a long
_BASES = (1_103_515_245, 1_664_525_013)


def _power(base: int, exponent: str, most: int) -> Column:
    """``base`` to the column ``exponent`` (0 to ``most``), modulo the prime: a factor per byte of it."""
    out = None
    for bit in range(0, most.bit_length(), 8):
        table = ",".join(f"{pow(base, byte << bit, _PRIME)}L" for byte in range(256))
        factor = F.expr(f"element_at(array({table}), CAST(shiftright({exponent}, {bit}) & 255 AS INT) + 1)")
        out = factor if out is None else out * factor % _PRIME
    return F.lit(1).cast("long") if out is None else out


def _shared_subtrees(a: DataFrame, b: DataFrame) -> int | None:
    """Number of subtrees of B that A has; None where it cannot be proven this way.

    A subtree's key is its size and two polynomials over its preorder tokens
    (value, children left and right), which are differences of running sums: no
    rounds.  Equal subtrees have equal keys.  The reverse is checked on all
    rows: if nodes of one key have one token, and their children at one offset
    one key, then equal keys are equal subtrees, from the smallest upwards.  Two
    subtrees that met in a key would fail it, as do positions that repeat (ids
    that repeat)."""
    rows = lambda t, tag: t.select(F.lit(tag).alias("tree"), "id", F.when(F.col("level") > 0, F.col("parent")).alias("parent"),
                                   F.col("pre_pos").alias("pos"), "size", "val", "n_left", "n_right")
    both = rows(a, "a").unionByName(rows(b, "b"))
    total, most = both.agg(F.count(F.lit(1)), F.coalesce(F.max("pos"), F.lit(0))).first()
    own = [F.pmod(F.xxhash64(F.lit(i), "val", "n_left", "n_right"), F.lit(_PRIME)) * _power(r, "pos", most) % _PRIME
           for i, r in enumerate(_BASES)]
    both = both.select("*", *[c.alias(f"w{i}") for i, c in enumerate(own)])
    sums = [Agg(f"upto{i}", "sum", F.col(f"w{i}")) for i in range(len(_BASES))]
    summed = materialize(ordered_scan(both, [], ["tree", "pos"], [Agg("at", "count", F.lit(1)), *sums]))
    shift = F.col("at") - F.col("pos")  # one a tree where its positions are 1 to n
    if not summed.groupBy("tree").agg((F.min(shift) == F.max(shift)).alias("ok")).agg(
            F.coalesce(F.bool_and("ok"), F.lit(True))).first()[0]:
        return None
    last = summed.select("tree", F.col("pos").alias("_end"), *[F.col(f"upto{i}").alias(f"_e{i}") for i in range(len(_BASES))])
    part = [(F.col(f"_e{i}") - F.col(f"upto{i}") + F.col(f"w{i}")) % _PRIME * _power(pow(r, -1, _PRIME), "pos", most) % _PRIME
            for i, r in enumerate(_BASES)]
    keyed = materialize(summed.withColumn("_end", F.col("pos") + F.col("size") - 1).join(last, ["tree", "_end"]).select(
        "tree", "id", "parent", "pos", "val", "n_left", "n_right", "size", *[c.alias(f"key{i}") for i, c in enumerate(part)]))
    key = ["size", *[f"key{i}" for i in range(len(_BASES))]]
    one = lambda c: F.min(c).eqNullSafe(F.max(c))
    in_a, in_b = (F.count(F.when(F.col("tree") == tag, 1)) for tag in "ab")
    n = F.count(F.lit(1))
    classes = keyed.groupBy(*key).agg(
        n.alias("n"), in_a.alias("in_a"), in_b.alias("in_b"),
        (one("val") & one("n_left") & one("n_right") & F.count("val").isin(F.lit(0), n)).alias("ok"))
    found, rows_seen, ok = classes.agg(F.coalesce(F.sum(F.when(F.col("in_a") > 0, F.col("in_b"))), F.lit(0)),
                                       F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.bool_and("ok"), F.lit(True))).first()
    if not ok or rows_seen != total:
        return None
    above = keyed.select("tree", F.col("id").alias("parent"), F.col("pos").alias("_pos"), *[F.col(c).alias(f"_{c}") for c in key])
    kids = keyed.where("parent IS NOT NULL").select("tree", "parent", "pos", *key).join(above, ["tree", "parent"])
    alike = kids.groupBy(*[f"_{c}" for c in key], (F.col("pos") - F.col("_pos")).alias("_offset")).agg(
        (one(key[0]) & one(key[1]) & one(key[2])).alias("ok"))
    return found if alike.where("NOT ok").isEmpty() else None


def tree_compare(tree_a: Tree, tree_b: Tree) -> DataFrame:
    """Equal (same shape and values), mirror-equal (B with sides swapped) and
    the number of B subtrees found among A's subtrees.  At most one child a
    side; two empty trees are equal.  The mirror's preorder is B's post-order
    backwards."""
    a, b = preorder(tree_a), preorder(tree_b)
    size_b = b.agg(F.count(F.lit(1)).alias("_all"))
    ta = a.select("pre_pos", F.struct("val", "n_left", "n_right").alias("ta"))
    tb = b.select("pre_pos", F.struct("val", "n_left", "n_right").alias("tb"))
    post = F.col("pre_pos") - 1 - F.col("level") + F.col("size")
    tm = b.join(F.broadcast(size_b)).select(  # one row
        (F.col("_all") + 1 - post).alias("pre_pos"),
        F.struct("val", F.col("n_right").alias("n_left"), F.col("n_left").alias("n_right")).alias("tb"))
    agree = F.coalesce(F.bool_and(F.col("ta").eqNullSafe(F.col("tb"))), F.lit(True))
    same = ta.join(tb, "pre_pos", "full").agg(agree.alias("equal"))
    mirror = ta.join(tm, "pre_pos", "full").agg(agree.alias("mirror"))
    shared = _shared_subtrees(a, b)
    if shared is not None:
        found = a.sparkSession.range(1).select(F.lit(shared).cast("long").alias("b_subtrees_in_a"))
    else:
        classes = _same_subtrees(a, b)
        key = ["size", "head", "tail"]
        found = (classes.where("tree = 'b'").join(classes.where("tree = 'a'").select(key).distinct(), key, "left_semi")
                 .agg(F.count(F.lit(1)).alias("b_subtrees_in_a")))
    return same.unionByName(mirror, allowMissingColumns=True).unionByName(found, allowMissingColumns=True).agg(
        F.max("equal").alias("equal"), F.max("mirror").alias("mirror"), F.max("b_subtrees_in_a").alias("b_subtrees_in_a"))


def merge_trees(tree_a: Tree, tree_b: Tree) -> DataFrame:
    """Node-by-node sum on equal path codes; a missing side is taken as is.
    Both trees are made with ``codes=True``: the result names nodes by them."""
    a = tree_a.rows.select("code", F.col("val").alias("va"))
    b = tree_b.rows.select("code", F.col("val").alias("vb"))
    j = a.join(b, "code", "full")
    return j.select("code", (F.coalesce("va", F.lit(0)) + F.coalesce("vb", F.lit(0))).alias("val"))


def outline_paths(lines: DataFrame, line_no: str = "line_no", line: str = "line", sep: str = "/") -> DataFrame:
    """Indented outline (tab = one level) to full paths.  The parent of a
    line is the last earlier line one level up (as-of lookup keyed by level);
    paths are then joined up by pointer doubling."""
    from ..plans.asof import asof_lookup
    l = lines.select(F.col(line_no).alias("ln"), F.length(F.regexp_extract(line, r"^(\t*)", 1)).cast("long").alias("lvl"),
                     F.regexp_replace(line, r"^\t*", "").alias("name"))
    probe = l.withColumn("plvl", F.col("lvl") - 1)
    right = l.select(F.col("lvl").alias("plvl"), F.col("ln").alias("pln"))
    with_parent = asof_lookup(probe, right, ["plvl"], F.col("ln"), F.col("pln"), ["pln"], strict=True, prefix="_p")
    nodes = materialize(with_parent.select("ln", "lvl", "name", F.col("_ppln").alias("parent")))
    start = nodes.where((F.col("lvl") == 0) | F.col("parent").isNotNull()).select(
        F.col("ln").alias("id"), F.when(F.col("lvl") > 0, F.col("parent")).alias("up"), F.col("name").alias("path"))
    found, _ = ascend(start, {"path": lambda low, high: F.concat(high("path"), F.lit(sep), low("path"))})
    res = nodes.join(found.select(F.col("id").alias("ln"), "path"), "ln", "left")
    return res.select(F.col("ln").alias(line_no), "lvl", "name", "path",
                      F.col("name").contains(".").alias("is_file"), F.length("path").cast("long").alias("path_length"))
