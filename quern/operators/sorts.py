"""Sorts, limits, top-k and set operators (survey 2.6, 2.7).

Top-k is ``orderBy().limit(k)`` (TakeOrderedAndProject: each task keeps k
rows); per-key limits are ``row_number() <= n`` (a partial WindowGroupLimit
runs before the shuffle).  Positions in a sorted result come from the
skew-safe scan, never from a window without partition keys.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.keys import key_join
from ..plans.scan import row_index


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squared_distance(vec: Column, query: Column) -> Column:
    """Sum of squared component differences, in double, left to right."""
    diffs = F.zip_with(vec, query, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def k_nearest(points: DataFrame, id_col: str, vec: str, query: DataFrame, qvec: str, k: int,
              name: str = "rank") -> DataFrame:
    """k points of least squared distance to the query vector (ties by id).
    ``query`` holds exactly one row: it is joined on a constant key and
    broadcast (size one row)."""
    q = query.select(F.col(qvec).alias("_q")).limit(1).withColumn("_k", F.lit(1))
    p = points.withColumn("_k", F.lit(1)).join(F.broadcast(q), "_k")
    d = p.select(id_col, squared_distance(F.col(vec), F.col("_q")).alias("dist2"))
    top = d.orderBy("dist2", id_col).limit(k)
    w = Window.orderBy("dist2", id_col)  # k rows only
    return top.select(id_col, F.row_number().over(w).cast("long").alias(name))


def k_nearest_xy(points: DataFrame, id_col: str, x: str, y: str, k: int) -> DataFrame:
    """k points closest to the origin (x*x + y*y, ties by id)."""
    return (points.select(id_col, x, y, (F.col(x) * F.col(x) + F.col(y) * F.col(y)).alias("dist2"))
            .orderBy("dist2", id_col).limit(k))


def stable_partition(df: DataFrame, keys: Sequence[str], order: Sequence[str], pred: Column,
                     name: str = "new_pos") -> DataFrame:
    """Rows matching ``pred`` first, each class in its old order: the new
    position per key is the row number over (class, old order)."""
    c = df.withColumn("_cls", F.when(pred, 0).otherwise(1))
    return row_index(c, keys, ["_cls", *order], name=name).drop("_cls")


def compound_sort(df: DataFrame, log_id: Column, content: Column, pos: Column, name: str = "sort_pos") -> DataFrame:
    """Letter logs (content starts with a letter) by content, then id; digit
    logs after them in input order.  Returns every row with its position."""
    is_digit = F.when(F.substring(content, 1, 1).rlike("^[0-9]"), 1).otherwise(0)
    c = df.select("*", is_digit.alias("_dig"),
                  F.when(is_digit == 0, content).alias("_ct"), F.when(is_digit == 0, log_id).alias("_id"),
                  pos.alias("_pos"))
    r = row_index(c, [], ["_dig", "_ct", "_id", "_pos"], name=name)
    return r.drop("_dig", "_ct", "_id", "_pos")


def order_by_transform(df: DataFrame, expr: Column, id_col: str, name: str = "pos") -> DataFrame:
    """Global position of each row ordered by an expression (ties by id)."""
    return row_index(df.withColumn("_t", expr), [], ["_t", id_col], name=name).drop("_t")


def keep_first_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """At most n rows per key, the first ones in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def rank_smaller(df: DataFrame, keys: Sequence[str], val: str, name: str = "n_smaller") -> DataFrame:
    """How many values of the key are strictly smaller than the row's value:
    counts per (key, value), then an exclusive running sum over values."""
    from ..plans.scan import Agg, ordered_scan
    c = df.groupBy(*keys, val).agg(F.count(F.lit(1)).alias("_c"))
    s = ordered_scan(c, keys, [val], [Agg(name, "sum", F.col("_c"), exclusive=True)])
    s = s.select(*keys, val, F.coalesce(F.col(name), F.lit(0)).alias(name))
    return key_join(df, s, [*keys, val])


def weakest_groups(df: DataFrame, row: str, flag: Column, k: int, name: str = "ones") -> DataFrame:
    """k groups with the fewest set flags, ties by group id."""
    return (df.groupBy(row).agg(F.sum(F.when(flag, 1).otherwise(0)).alias(name))
            .orderBy(name, row).limit(k))


def shuffle_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows in a random order fixed by ``seed``: the order of the md5 of key
    and seed, so neither the partitioning nor a re-run changes it."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def intersect_bag(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersectAll(b)


def merge_sorted(dfs: Sequence[DataFrame], key: str, name: str = "pos") -> DataFrame:
    """Union of sorted inputs as one sorted series with positions."""
    u = dfs[0]
    for d in dfs[1:]:
        u = u.unionByName(d)
    return row_index(u, [], [key], name=name)
