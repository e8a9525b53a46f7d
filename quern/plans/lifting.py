"""Pointer doubling over parent pointers.

A table ``(id, up, values)`` has one row per node; ``up`` is null at a root.
Round k joins every row that still has an ``up`` with that node's row, so its
pointer then spans 2^(k+1) nodes: log2(depth) rounds of one equi-join of n rows,
whatever the shape (a chain of a million nodes takes 20).  The pointers of each
round are kept as *lifts*: ``lifts[k]`` is (id, up) with ``up`` the 2^k-th
ancestor.  Folds over subtrees run the same lifts the other way, as partial
aggregates on ``up``.  Nothing holds a path or a subtree in one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .loops import materialize, union_all

Combine = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def ascend(start: DataFrame, combine: dict[str, Combine], rounds: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Values over the whole path from each node to its root, and the lifts.

    ``combine[c](low, high)`` is the value of ``c`` over a stretch of path from
    the values ``low(name)`` of its lower part and ``high(name)`` of the part
    above.  Ids are unique.  Rows without a root (on or below a cycle, or under
    a node that has no row) are left out; other columns keep the node's own
    values.  The rounds end when no row has an ancestor left, or when the
    pointers span more nodes than there are; ``rounds`` gives their number where
    an earlier climb of the same pointers found it."""
    start = materialize(start)
    own = [c for c in start.columns if c not in combine and c != "up"]
    total = None
    done, active, lifts, span = [start.where("up IS NULL")], start.where("up IS NOT NULL"), [], 1
    while len(lifts) != rounds and not (rounds is None and active.isEmpty()):
        if rounds is None:
            total = start.count() if total is None else total
            if span > total:
                break
        lifts.append(active.select("id", "up"))
        above = union_all([*done, active]).select(
            F.col("id").alias("_h_id"), F.col("up").alias("_h_up"), *[F.col(c).alias(f"_h_{c}") for c in combine])
        step = active.join(above, F.col("up") == F.col("_h_id")).select(
            *own, F.col("_h_up").alias("up"),
            *[f(F.col, lambda n: F.col(f"_h_{n}")).alias(c) for c, f in combine.items()])
        step = materialize(step.select(start.columns))
        done.append(step.where("up IS NULL"))
        active = step.where("up IS NOT NULL")
        span *= 2
    return materialize(union_all(done).drop("up")), lifts


def descend(rows: DataFrame, lifts: list[DataFrame], values: dict[str, Callable[[str], Column]]) -> DataFrame:
    """(id, values) with every value folded over the node's subtree, itself
    included; ``values[c]`` is a commutative aggregate (``F.sum``, ``F.max``).

    After round k a row holds the fold over its descendants fewer than 2^(k+1)
    levels down: its own so far, and that of every node 2^k levels below."""
    state = rows.select("id", *values)
    for lift in lifts:
        below = lift.join(state, "id").select(F.col("up").alias("id"), *values)
        state = materialize(state.unionByName(below).groupBy("id").agg(*[f(c).alias(c) for c, f in values.items()]))
    return state


def ancestor_pairs(nodes: DataFrame, lifts: list[DataFrame]) -> DataFrame:
    """(id, ancestor, dist) for every id of ``nodes`` and each of its ancestors,
    itself at distance 0 included: as many rows as the paths are long."""
    pairs = nodes.select("id", F.col("id").alias("ancestor"), F.lit(0).cast("long").alias("dist"))
    for k, lift in enumerate(lifts):
        up = lift.select(F.col("id").alias("_n"), "up")
        far = pairs.join(up, F.col("ancestor") == F.col("_n")).select(
            "id", F.col("up").alias("ancestor"), (F.col("dist") + (1 << k)).alias("dist"))
        pairs = materialize(pairs.unionByName(far))
    return pairs
