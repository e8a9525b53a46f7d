"""Window and sequence operators over ordered series (survey 2.5).

A series is a table ``(keys..., order..., value)``.  Every running quantity
comes from :func:`quern.plans.scan.ordered_scan`, which splits hot keys, so
no operator here puts a whole key into one task.  Fixed offsets (``lag k``,
frames of the last n rows, windows of fixed length) are equi-joins on
``(keys, row number)``, which spread a hot key evenly.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.asof import asof_lookup
from ..plans.keys import key_join
from ..plans.loops import materialize
from ..plans.scan import Agg, ordered_scan, previous, row_index


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at_offset(df: DataFrame, keys: Sequence[str], rn: str, offset: int, cols: Sequence[str],
              prefix: str) -> DataFrame:
    """Values of the row ``rn + offset`` of the same key (lag/lead by k) by an
    equi-join on (keys, row number)."""
    other = df.select(*[F.col(k).alias(f"_at_{k}") for k in keys], (F.col(rn) - offset).alias("_at_rn"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    cond = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys] + [F.col(rn) == F.col("_at_rn")]
    return df.join(other, cond, "left").drop("_at_rn", *[f"_at_{k}" for k in keys])


# ---------------------------------------------------------------- prefix forms

def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str,
                name: str = "running", op: str = "sum") -> DataFrame:
    """Inclusive prefix sum (``op='xor'`` for the running xor) per key."""
    return ordered_scan(df, keys, order, [Agg(name, op, _c(val))])


def greater_sum(df: DataFrame, keys: Sequence[str], val: str, name: str = "greater_sum") -> DataFrame:
    """Sum of all values >= the row's value in its key (ties included)."""
    per_val = df.groupBy(*keys, val).agg(F.sum(val).alias("_s"))
    suff = ordered_scan(per_val, keys, [val], [Agg(name, "sum", F.col("_s"))], descending=True).drop("_s")
    return key_join(df, suff, [*keys, val])


def range_sum_query(series: DataFrame, queries: DataFrame, keys: Sequence[str], pos: str, val: str,
                    lo: str = "lo", hi: str = "hi", updates: DataFrame | None = None, upd_ts: str = "ts",
                    op: str = "sum", name: str = "range_sum") -> DataFrame:
    """Sum (or xor) of the values at positions lo..hi per query row.

    Optional point updates ``(keys, pos, val, ts)``: the latest update of a
    position replaces its value.  Prefix table once, then two as-of reads at
    ``hi`` and ``lo - 1`` (missing positions are fine)."""
    # one value per position, so the as-of read sees one prefix per position
    fold = F.bit_xor(val) if op == "xor" else F.sum(val)
    s = series.groupBy(*keys, pos).agg(fold.alias(val))
    if updates is not None:  # by union, not by join: null keys and new positions count like others
        last = updates.groupBy(*keys, pos).agg(F.max_by(val, upd_ts).alias("_new"))
        s = (s.withColumn("_new", F.lit(None).cast(last.schema["_new"].dataType))
             .unionByName(last.withColumn(val, F.lit(None).cast(s.schema[val].dataType)))
             .groupBy(*keys, pos).agg(F.coalesce(F.max("_new"), F.max(val)).alias(val)))
    pre = ordered_scan(s, keys, [pos], [Agg("_p", op, F.col(val))])
    q = queries
    a = asof_lookup(q, pre, keys, F.col(hi), F.col(pos), ["_p"], prefix="_hi")
    b = asof_lookup(a, pre, keys, F.col(lo) - 1, F.col(pos), ["_p"], prefix="_lo")
    ph, pl = F.coalesce(F.col("_hi_p"), F.lit(0)), F.coalesce(F.col("_lo_p"), F.lit(0))
    res = ph.bitwiseXOR(pl) if op == "xor" else ph - pl
    return b.withColumn(name, res).drop("_hi_p", "_lo_p")


def timed_range_sums(updates: DataFrame, queries: DataFrame, keys: Sequence[str], pos: str, val: str, ts: str,
                     lo: str = "lo", hi: str = "hi", name: str = "range_sum") -> DataFrame:
    """Sum of the values at positions lo..hi as they were at each query's
    ``ts``: an update at or before it sets its position's value (a position without one
    is 0, a null value counts as 0; times of one position should differ).

    Offline dominance sums: an update adds the difference to its position's
    last value to every block of 2^l positions that holds it; a query's prefix
    of positions is cut into at most one block per l, each read as of the
    query's time.  Rows grow by the logarithm of the span of positions, and a
    hot key or block is split by the scan."""
    keys = list(keys)
    u = updates.select(*keys, F.col(pos).cast("long").alias("_pos"), F.col(ts).alias("_ts"), F.coalesce(F.col(val), F.lit(0)).alias("_v"))
    first, last = updates.agg(F.min(pos), F.max(pos)).first()
    first, last = int(first or 0), int(last or 0)
    levels = max(1, (last - first + 1).bit_length())
    u = previous(u, [*keys, "_pos"], ["_ts"], ["_v"], prefix="_old")
    u = u.select(*keys, "_ts", (F.col("_v") - F.coalesce("_old_v", F.lit(0))).alias("_d"), (F.col("_pos") - first).alias("_at"),
                 F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_lv"))
    u = u.withColumn("_block", F.expr("shiftright(_at, _lv)")).groupBy(*keys, "_lv", "_block", "_ts").agg(F.sum("_d").alias("_d"))
    pre = ordered_scan(u, [*keys, "_lv", "_block"], ["_ts"], [Agg("_p", "sum", F.col("_d"))])
    q = materialize(queries.withColumn("_q", F.monotonically_increasing_id()))
    clip = lambda c: F.least(F.greatest(c - first, F.lit(0)), F.lit(last - first + 1)).cast("long")
    ends = [(clip(F.col(hi) + 1), 1), (clip(F.col(lo)), -1)]  # prefixes of so many positions
    cut = q.select("_q", *keys, ts, F.explode(F.array(*[F.struct(n.alias("n"), F.lit(sign).alias("sign")) for n, sign in ends])).alias("e"))
    cut = (cut.select("_q", *keys, ts, "e.n", "e.sign", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_lv"))
           .where(F.expr("shiftright(n, _lv) % 2 = 1")).withColumn("_block", F.expr("shiftright(n, _lv) - 1")))
    top = cut.where(F.col("_lv") < levels)
    read = asof_lookup(top, pre, [*keys, "_lv", "_block"], F.col(ts), F.col("_ts"), ["_p"])
    sums = read.groupBy(F.col("_q").alias("_of")).agg(F.sum(F.col("sign") * F.col("_p")).alias("_sum"))
    zero = F.lit(0).cast(sums.schema["_sum"].dataType)
    return (q.join(sums, F.col("_q") == F.col("_of"), "left")
            .select(*queries.columns, F.when(F.col(lo) <= F.col(hi), F.coalesce("_sum", zero)).otherwise(zero).alias(name)))


def range_update(updates: DataFrame, start: str, end: str, val: str | None = None,
                 keys: Sequence[str] = (), name: str = "value") -> DataFrame:
    """Add ``val`` (1 by default) to every position start..end; return every
    position between the smallest start and the largest end with its total.
    Difference array: +v at start, -v at end + 1, then a running sum over the
    position spine."""
    v = _c(val) if val else F.lit(1)
    keys = list(keys)
    deltas = (updates.select(*keys, F.col(start).alias("pos"), v.alias("d"))
              .unionAll(updates.select(*keys, (F.col(end) + 1).alias("pos"), (-v).alias("d")))
              .groupBy(*keys, "pos").agg(F.sum("d").alias("d")))
    bounds = updates.groupBy(*keys).agg(F.min(start).alias("_lo"), F.max(end).alias("_hi"))
    spine = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("pos"))
    filled = key_join(spine, deltas, [*keys, "pos"], "left").fillna(0, ["d"])
    return ordered_scan(filled, keys, ["pos"], [Agg(name, "sum", F.col("d"))]).drop("d")


def moving_average(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, n: int,
                   name: str = "moving_avg") -> DataFrame:
    """Mean of the non-null values of the last n rows (fewer at the start):
    (P(i) - P(i-n)) / (C(i) - C(i-n)) with running sums P and counts C of
    non-null values; null when there are none."""
    s = ordered_scan(df, keys, order, [Agg("_rn", "count", F.lit(1)), Agg("_p", "sum", _c(val)), Agg("_n", "count", _c(val))])
    back = s.select(*[F.col(k).alias(f"_b_{k}") for k in keys], (F.col("_rn") + n).alias("_b_rn"),
                    F.col("_p").alias("_pb"), F.col("_n").alias("_nb"))
    j = s.join(back, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys] + [F.col("_rn") == F.col("_b_rn")], "left")
    seen = F.col("_n") - F.coalesce("_nb", F.lit(0))
    avg = F.when(seen > 0, (F.col("_p") - F.coalesce("_pb", F.lit(0))) / seen)
    return j.select(*df.columns, avg.cast("double").alias(name))


def recent_count(df: DataFrame, keys: Sequence[str], t: str, span, id_col: str,
                 name: str = "recent") -> DataFrame:
    """Rows of the same key with time in [t - span, t] (equal times count each
    other).  Each row adds two probes (at t - span before equal times, at t
    after them); one running count of real rows answers both."""
    base = df.select(*keys, F.col(t).alias("_t"), F.col(id_col).alias("_id"))
    u = (base.withColumn("_kind", F.lit(1))
         .unionByName(base.withColumn("_t", F.col("_t") - span).withColumn("_kind", F.lit(0)))
         .unionByName(base.withColumn("_kind", F.lit(2))))
    s = ordered_scan(u, keys, ["_t", "_kind", "_id"],
                     [Agg("_c", "count", F.when(F.col("_kind") == 1, F.lit(1)))])
    r = s.groupBy(*keys, "_id").agg((F.max(F.when(F.col("_kind") == 2, F.col("_c")))
                                     - F.max(F.when(F.col("_kind") == 0, F.col("_c")))).alias(name))
    return key_join(df, r.withColumnRenamed("_id", id_col), [*keys, id_col])


# ---------------------------------------------------------------- trades and segments

def best_single_trade(df: DataFrame, keys: Sequence[str], order: Sequence[str], price: str,
                      name: str = "best_profit") -> DataFrame:
    """Max later-minus-earlier price per key, 0 if never positive."""
    s = ordered_scan(df, keys, order, [Agg("_mn", "min", _c(price))])
    return s.groupBy(*keys).agg(F.greatest(F.max(F.col(price) - F.col("_mn")), F.lit(0)).alias(name))


def sum_of_rises(df: DataFrame, keys: Sequence[str], order: Sequence[str], price: str,
                 name: str = "sum_rises") -> DataFrame:
    """Sum of positive step-to-step rises per key."""
    p = previous(df, keys, order, [price], prefix="_prev_")
    return p.groupBy(*keys).agg(
        F.coalesce(F.sum(F.greatest(F.col(price) - F.col(f"_prev_{price}"), F.lit(0))), F.lit(0)).alias(name))


def best_two_trades(df: DataFrame, keys: Sequence[str], order: Sequence[str], price: str,
                    name: str = "best_two") -> DataFrame:
    """Best total of at most two non-overlapping trades per key."""
    a = ordered_scan(df, keys, order, [Agg("_mn", "min", _c(price))])
    a = ordered_scan(a.withColumn("_gain", F.col(price) - F.col("_mn")), keys, order,
                     [Agg("_f", "max", F.col("_gain"))])
    b = ordered_scan(a, keys, order, [Agg("_mx", "max", _c(price))], descending=True)
    b = ordered_scan(b.withColumn("_gain2", F.col("_mx") - F.col(price)), keys, order,
                     [Agg("_g", "max", F.col("_gain2"))], descending=True)
    return b.groupBy(*keys).agg(F.greatest(F.max(F.col("_f") + F.col("_g")), F.lit(0)).alias(name))


def max_segment_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str,
                    name: str = "max_sum") -> DataFrame:
    """Largest non-empty contiguous sum: max of P(i) - min(0, P(j<i))."""
    s = ordered_scan(df, keys, order, [Agg("_p", "sum", _c(val))])
    s = ordered_scan(s, keys, order, [Agg("_pm", "min", F.col("_p"), exclusive=True)])
    return s.groupBy(*keys).agg(F.max(F.col("_p") - F.least(F.coalesce("_pm", F.lit(0)), F.lit(0))).alias(name))


def segments_with_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, k,
                      name: str = "segments") -> DataFrame:
    """Number of contiguous segments whose sum is k, per key.

    Prefix sums P(0)=0, P(1..n); a segment (i, j] has sum k when
    P(i) = P(j) - k.  Prefix rows (match = P) and probe rows (match = P - k)
    go into one series per (key, match); a running count of prefixes seen
    before each probe gives its number of partners.  Linear, no pair join."""
    s = ordered_scan(df, keys, order, [Agg("_p", "sum", _c(val)), Agg("_i", "count", F.lit(1))])
    starts = df.select(*keys).distinct().select(*keys, F.lit(0).cast(s.schema["_p"].dataType).alias("_p"),
                                                F.lit(0).cast("long").alias("_i"))
    prefixes = s.select(*keys, "_p", "_i").unionByName(starts)
    u = (prefixes.select(*keys, F.col("_p").alias("_m"), "_i", F.lit(1).alias("_kind"))
         .unionByName(s.select(*keys, (F.col("_p") - F.lit(k)).alias("_m"), "_i", F.lit(0).alias("_kind"))))
    c = ordered_scan(u, [*keys, "_m"], ["_i", "_kind"], [Agg("_n", "count", F.when(F.col("_kind") == 1, 1))])
    probes = c.where(F.col("_kind") == 0)
    counts = probes.groupBy(*keys).agg(F.sum("_n").alias(name))
    return key_join(df.select(*keys).distinct(), counts, keys, "left").fillna(0, [name])


def balance_point(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, pos: str,
                  name: str = "pivot") -> DataFrame:
    """First ``pos`` whose left sum equals its right sum, -1 if none."""
    s = ordered_scan(df, keys, order, [Agg("_l", "sum", _c(val), exclusive=True)])
    tot = df.groupBy(*keys).agg(F.sum(val).alias("_tot"))
    j = key_join(s, tot, keys)
    left = F.coalesce(F.col("_l"), F.lit(0))
    hit = F.when(left == F.col("_tot") - left - F.col(val),
                 F.struct(*[_c(o).alias(f"_o{i}") for i, o in enumerate(order)], F.col(pos).alias("_pos")))
    r = j.groupBy(*keys).agg(F.min(hit).alias("_h"))
    return r.select(*keys, F.coalesce(F.col("_h._pos"), F.lit(-1)).alias(name))


def leave_one_out(df: DataFrame, keys: Sequence[str], val: str) -> DataFrame:
    """Product and sum of all OTHER rows of the key; zeros handled without
    dividing by zero (zero count + product of the non-zero values)."""
    g = df.groupBy(*keys).agg(F.sum(val).alias("_s"),
                              F.sum(F.when(F.col(val) == 0, 1).otherwise(0)).alias("_z"),
                              F.product(F.when(F.col(val) != 0, F.col(val)).otherwise(F.lit(1))).alias("_p"))
    j = key_join(df, g, keys)
    prod = (F.when(F.col("_z") == 0, F.col("_p") / F.col(val))
            .when((F.col("_z") == 1) & (F.col(val) == 0), F.col("_p"))
            .otherwise(F.lit(0.0)))
    return j.select(*df.columns, prod.alias("product_others"), (F.col("_s") - F.col(val)).alias("sum_others"))


# ---------------------------------------------------------------- runs, islands, gaps

def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str) -> DataFrame:
    """Maximal runs of equal values: value, start, end, length (positions 1-based).
    Islands rule: row number per key minus row number per (key, value) is
    constant inside a run."""
    a = row_index(df, keys, order, name="_rk")
    b = row_index(a, [*keys, val], order, name="_rv")
    g = b.withColumn("_g", F.col("_rk") - F.col("_rv"))
    return g.groupBy(*keys, val, "_g").agg(F.min("_rk").alias("start_pos"), F.max("_rk").alias("end_pos"),
                                           F.count(F.lit(1)).alias("length")).drop("_g")


def longest_run(df: DataFrame, keys: Sequence[str], order: Sequence[str], cond: Column,
                name: str = "longest_run") -> DataFrame:
    """Longest run of consecutive rows where ``cond`` holds, per key (0 if none)."""
    s = ordered_scan(df.withColumn("_ok", cond), keys, order,
                     [Agg("_rn", "count", F.lit(1)), Agg("_t", "count", F.when(F.col("_ok"), 1))])
    runs_ = (s.where(F.col("_ok")).groupBy(*keys, (F.col("_rn") - F.col("_t")).alias("_g"))
             .agg(F.count(F.lit(1)).alias("_len")))
    best = runs_.groupBy(*keys).agg(F.max("_len").alias(name))
    return key_join(df.select(*keys).distinct(), best, keys, "left").fillna(0, [name])


def longest_rising(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str,
                   name: str = "longest_rising") -> DataFrame:
    """Longest strictly rising contiguous run (in elements)."""
    p = previous(df, keys, order, [val], prefix="_pv_")
    r = longest_run(p, keys, order, F.col(val) > F.col(f"_pv_{val}"), name="_r")
    return r.select(*keys, (F.col("_r") + 1).alias(name))


def islands(df: DataFrame, keys: Sequence[str], val: str) -> DataFrame:
    """Distinct integers as closed ranges (start, end, length) per key."""
    d = df.select(*keys, val).distinct()
    r = row_index(d, keys, [val], name="_r")
    return (r.groupBy(*keys, (F.col(val) - F.col("_r")).alias("_g"))
            .agg(F.min(val).alias("range_start"), F.max(val).alias("range_end"),
                 F.count(F.lit(1)).alias("length")).drop("_g"))


def gaps(df: DataFrame, keys: Sequence[str], val: str, lo: Column | None = None,
         hi: Column | None = None) -> DataFrame:
    """Missing closed ranges between the distinct values of a key, or from
    ``lo`` and up to ``hi`` where given: values beyond a bound are left out, and
    a key without values inside has the whole range as its gap."""
    d = df.select(*keys, val).distinct()
    kind = d.schema[val].dataType
    ends = [(b + step).cast(kind) for b, step in ((lo, -1), (hi, 1)) if b is not None]
    if ends:
        ks = d.select(*keys).distinct()
        for b, inside in ((lo, F.col(val) >= lo if lo is not None else None), (hi, F.col(val) <= hi if hi is not None else None)):
            if b is not None:
                d = d.where(inside)
        d = d.unionByName(ks.select(*keys, F.explode(F.array(*ends)).alias(val)))
    p = previous(d, keys, [val], [val], prefix="_pv_")
    return (p.where(F.col(val) - F.col(f"_pv_{val}") > 1)
            .select(*keys, (F.col(f"_pv_{val}") + 1).alias("gap_start"), (F.col(val) - 1).alias("gap_end")))


def first_missing_positive(df: DataFrame, keys: Sequence[str], val: str,
                           name: str = "first_missing") -> DataFrame:
    """Smallest positive integer absent from the key's values."""
    d = df.select(*keys, val).where(F.col(val) > 0).distinct()
    r = row_index(d, keys, [val], name="_r")
    g = r.groupBy(*keys).agg(F.min(F.when(F.col(val) != F.col("_r"), F.col("_r"))).alias("_m"),
                             F.count(F.lit(1)).alias("_n"))
    res = g.select(*keys, F.coalesce("_m", F.col("_n") + 1).alias(name))
    return key_join(df.select(*keys).distinct(), res, keys, "left").fillna(1, [name])


def kth_missing_positive(df: DataFrame, keys: Sequence[str], val: str, k: int,
                         name: str = "kth_missing") -> DataFrame:
    """k-th positive integer absent from the key's values: with sorted
    distinct values a_i (i from 1), a_i - i values are missing before a_i,
    so the answer is k + #{i : a_i - i < k}."""
    d = df.select(*keys, val).where(F.col(val) > 0).distinct()
    r = row_index(d, keys, [val], name="_r")
    g = r.groupBy(*keys).agg(F.sum(F.when(F.col(val) - F.col("_r") < k, 1).otherwise(0)).alias("_c"))
    res = g.select(*keys, (F.col("_c") + k).cast("long").alias(name))
    return key_join(df.select(*keys).distinct(), res, keys, "left").fillna(k, [name])


def has_multiple_segment(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, m: int,
                         name: str = "has_multiple") -> DataFrame:
    """Is there a segment of length >= 2 whose sum is a multiple of m?  Two
    prefix sums (P(0) = 0 included) with equal residue at least 2 apart."""
    s = ordered_scan(df, keys, order, [Agg("_p", "sum", _c(val)), Agg("_i", "count", F.lit(1))])
    starts = df.select(*keys).distinct().select(*keys, F.lit(0).cast(s.schema["_p"].dataType).alias("_p"),
                                                F.lit(0).cast("long").alias("_i"))
    p = s.select(*keys, "_p", "_i").unionByName(starts)
    g = p.groupBy(*keys, F.pmod(F.col("_p"), F.lit(m)).alias("_res")).agg((F.max("_i") - F.min("_i")).alias("_w"))
    return g.groupBy(*keys).agg((F.max("_w") >= 2).alias(name))


def max_gap(df: DataFrame, keys: Sequence[str], order: str, name: str = "max_gap") -> DataFrame:
    """Longest distance between neighbouring marks per key."""
    p = previous(df.select(*keys, order), keys, [order], [order], prefix="_pv_")
    return p.groupBy(*keys).agg(F.max(F.col(order) - F.col(f"_pv_{order}")).alias(name))


def local_peaks(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str) -> DataFrame:
    """Rows above both neighbours (outside the series counts as -infinity)."""
    p = previous(df, keys, order, [val], prefix="_pv_")
    n = previous(p, keys, order, [val], prefix="_nx_", descending=True)
    up = F.col(f"_pv_{val}").isNull() | (F.col(val) > F.col(f"_pv_{val}"))
    down = F.col(f"_nx_{val}").isNull() | (F.col(val) > F.col(f"_nx_{val}"))
    return n.where(up & down).select(*df.columns)


def turning_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, k: int) -> DataFrame:
    """Rows whose k values before are non-increasing and k values after are
    non-decreasing (run lengths by break positions, both directions)."""
    a = ordered_scan(df, keys, order, [Agg("_rn", "count", F.lit(1)),
                                       Agg("_pv", "last", F.struct(_c(val).alias("v")), exclusive=True)])
    a = ordered_scan(a, keys, order, [Agg("_nx", "last", F.struct(_c(val).alias("v")), exclusive=True)],
                     descending=True)
    # non-increasing run ending just before the row: last break (a rise) before it
    brk_up = F.when(F.col("_pv.v").isNull() | (_c(val) > F.col("_pv.v")), F.col("_rn"))
    brk_dn = F.when(F.col("_nx.v").isNull() | (_c(val) > F.col("_nx.v")), F.col("_rn"))
    b = ordered_scan(a, keys, order, [Agg("_lb", "last", brk_up, exclusive=True)])
    b = ordered_scan(b, keys, order, [Agg("_rb", "last", brk_dn, exclusive=True)], descending=True)
    left_len = F.col("_rn") - F.col("_lb")          # rows _lb .. _rn-1
    right_len = F.col("_rb") - F.col("_rn")         # rows _rn+1 .. _rb
    return b.where((left_len >= k) & (right_len >= k)).select(*df.columns)


def shortest_unsorted_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str,
                             name: str = "unsorted_len") -> DataFrame:
    """Length of the shortest window whose sorting sorts the whole series."""
    a = ordered_scan(df, keys, order, [Agg("_rn", "count", F.lit(1)), Agg("_pmax", "max", _c(val), exclusive=True)])
    b = ordered_scan(a, keys, order, [Agg("_smin", "min", _c(val), exclusive=True)], descending=True)
    g = b.groupBy(*keys).agg(F.min(F.when(_c(val) > F.col("_smin"), F.col("_rn"))).alias("_s"),
                             F.max(F.when(_c(val) < F.col("_pmax"), F.col("_rn"))).alias("_e"))
    return g.select(*keys, F.coalesce(F.col("_e") - F.col("_s") + 1, F.lit(0)).alias(name))


def one_change_nondecreasing(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str,
                             name: str = "fixable") -> DataFrame:
    """Can changing at most one value make the key's series non-decreasing?"""
    a = ordered_scan(df, keys, order, [Agg("_rn", "count", F.lit(1))])
    b = at_offset(a, keys, "_rn", -1, [val], "_p1_")
    b = at_offset(b, keys, "_rn", -2, [val], "_p2_")
    b = at_offset(b, keys, "_rn", 1, [val], "_n1_")
    v, p1, p2, n1 = _c(val), F.col(f"_p1_{val}"), F.col(f"_p2_{val}"), F.col(f"_n1_{val}")
    desc = p1.isNotNull() & (v < p1)
    ok_here = p2.isNull() | (v >= p2) | n1.isNull() | (n1 >= p1)
    g = b.groupBy(*keys).agg(F.sum(F.when(desc, 1).otherwise(0)).alias("_d"),
                             F.max(F.when(desc, ok_here.cast("int"))).alias("_ok"))
    return g.select(*keys, ((F.col("_d") == 0) | ((F.col("_d") == 1) & (F.col("_ok") == 1))).alias(name))


def remove_one_increasing(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str,
                          name: str = "removable") -> DataFrame:
    """Can removing exactly one value make the key's series strictly rising?
    At most one non-rise; at it, dropping the left or the right value must fit."""
    a = ordered_scan(df, keys, order, [Agg("_rn", "count", F.lit(1))])
    b = at_offset(a, keys, "_rn", -1, [val], "_p1_")
    b = at_offset(b, keys, "_rn", -2, [val], "_p2_")
    b = at_offset(b, keys, "_rn", 1, [val], "_n1_")
    v, p1, p2, n1 = _c(val), F.col(f"_p1_{val}"), F.col(f"_p2_{val}"), F.col(f"_n1_{val}")
    bad = p1.isNotNull() & (v <= p1)
    drop_left = p2.isNull() | (v > p2)
    drop_right = n1.isNull() | (n1 > p1)
    g = b.groupBy(*keys).agg(F.sum(F.when(bad, 1).otherwise(0)).alias("_d"),
                             F.max(F.when(bad, (drop_left | drop_right).cast("int"))).alias("_ok"))
    return g.select(*keys, ((F.col("_d") == 0) | ((F.col("_d") == 1) & (F.col("_ok") == 1))).alias(name))


def longest_no_loss_span(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str,
                         name: str = "span") -> DataFrame:
    """max j - i with i < j and v_i <= v_j (positions), 0 if none."""
    a = row_index(df, keys, order, name="_pos")
    b = ordered_scan(a, keys, [val, "_pos"], [Agg("_mp", "min", F.col("_pos"))])
    return b.groupBy(*keys).agg(F.max(F.col("_pos") - F.col("_mp")).alias(name))


def dip_area(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, name: str = "area") -> DataFrame:
    """Sum over rows of min(max left, max right) - v (trapped water)."""
    a = ordered_scan(df, keys, order, [Agg("_lm", "max", _c(val))])
    b = ordered_scan(a, keys, order, [Agg("_rm", "max", _c(val))], descending=True)
    return b.groupBy(*keys).agg(F.sum(F.least("_lm", "_rm") - _c(val)).alias(name))


# ---------------------------------------------------------------- item windows

def last_repeat_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str,
                       name: str = "longest_distinct") -> DataFrame:
    """Longest window with no repeated item per key."""
    a = row_index(df, keys, order, name="_pos")
    b = ordered_scan(a, [*keys, item], order, [Agg("_prev", "last", F.col("_pos"), exclusive=True)])
    c = ordered_scan(b, keys, order, [Agg("_st", "max", F.coalesce(F.col("_prev"), F.lit(0)) + 1)])
    return c.groupBy(*keys).agg(F.max(F.col("_pos") - F.col("_st") + 1).alias(name))


def k_distinct_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str, k: int,
                      name: str = "longest_k_distinct") -> DataFrame:
    """Longest window with at most k distinct items per key, whatever the items
    (null is an item).

    Level j knows, for each row, where the longest window of j distinct items
    that ends there starts and which item stands before it.  A row whose item is
    none of the last j starts a new window of level j: the one of level j - 1
    that ends at the row before, and this row.  So a level is the previous
    row's state of the level below and a running maximum: 2 k scans, no list of items."""
    a = row_index(df.select(*keys, *order, F.struct(F.col(item).alias("v")).alias("_item")), keys, order, name="_pos")
    rows = previous(a, keys, order, ["_item"], prefix="_last")
    last = [F.col("_last_item")]  # the distinct items before the row, latest first
    start, before = F.col("_pos"), F.col("_last_item")
    for j in range(1, k + 1):
        fresh = before.isNotNull()
        for x in last:
            fresh = fresh & ~F.col("_item").eqNullSafe(x)
        state = F.when(fresh, F.struct(start.alias("start"), before.alias("before")))
        rows = ordered_scan(rows, keys, order, [Agg(f"_s{j}", "max", state)])
        if j < k:
            rows = previous(rows, keys, order, [f"_s{j}"], prefix="_last")
            start, before = F.col(f"_last_s{j}")["start"], F.col(f"_last_s{j}")["before"]
            last.append(before)
    return rows.groupBy(*keys).agg(F.max(F.col("_pos") - F.coalesce(F.col(f"_s{k}")["start"], F.lit(1)) + 1).alias(name))


def bag_match_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str,
                      bag: dict, name: str = "start_pos") -> DataFrame:
    """Start positions of every window of length sum(bag) whose item counts
    equal the bag: running counts per bag item, differences at offset m."""
    m = sum(bag.values())
    items = list(bag)
    aggs = [Agg("_pos", "count", F.lit(1))] + [
        Agg(f"_c{i}", "count", F.when(F.col(item) == x, 1)) for i, x in enumerate(items)]
    s = ordered_scan(df, keys, order, aggs).select(*keys, "_pos", *[f"_c{i}" for i in range(len(items))])
    before = s.select(*[F.col(k).alias(f"_b_{k}") for k in keys], (F.col("_pos") + m).alias("_b_pos"),
                      *[F.col(f"_c{i}").alias(f"_b{i}") for i in range(len(items))])
    j = s.join(before, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys] + [F.col("_pos") == F.col("_b_pos")],
               "left")
    ok = F.col("_pos") >= m
    for i, x in enumerate(items):
        ok = ok & ((F.col(f"_c{i}") - F.coalesce(F.col(f"_b{i}"), F.lit(0))) == bag[x])
    return j.where(ok).select(*keys, (F.col("_pos") - m + 1).alias(name))


def min_cover_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str, need: dict,
                     name: str = "min_window") -> DataFrame:
    """Shortest window holding every needed item with multiplicity; on a tie
    the first (smallest start).  Per needed item x: the position of its
    need(x)-th most recent occurrence (occurrence number lookup by equi-join),
    then the window start is the least of them."""
    a = row_index(df, keys, order, name="_pos")
    items = list(need)
    occ = ordered_scan(a.where(F.col(item).isin(items)), [*keys, item], order, [Agg("_o", "count", F.lit(1))])
    # position of occurrence o of item x, keyed by the occurrence that makes it the need-th last
    look = occ.select(*keys, item, "_pos", "_o")
    cur = a
    aggs = [Agg(f"_n{i}", "count", F.when(F.col(item) == x, 1)) for i, x in enumerate(items)]
    cur = ordered_scan(cur, keys, order, aggs)
    for i, x in enumerate(items):
        lx = look.where(F.col(item) == x).select(*[F.col(k).alias(f"_x_{k}") for k in keys],
                                                F.col("_o").alias(f"_xo{i}"), F.col("_pos").alias(f"_xp{i}"))
        target = F.col(f"_n{i}") - need[x] + 1
        cur = cur.join(lx, [F.col(k).eqNullSafe(F.col(f"_x_{k}")) for k in keys] + [target == F.col(f"_xo{i}")],
                       "left").drop(*[f"_x_{k}" for k in keys], f"_xo{i}")
    start = F.least(*[F.col(f"_xp{i}") for i in range(len(items))]) if len(items) > 1 else F.col("_xp0")
    full = F.lit(True)
    for i in range(len(items)):
        full = full & F.col(f"_xp{i}").isNotNull()
    w = cur.where(full).select(*keys, start.alias("_s"), F.col("_pos").alias("_e"))
    best = w.groupBy(*keys).agg(F.min(F.struct((F.col("_e") - F.col("_s") + 1).alias("len"), "_s", "_e")).alias("_b"))
    return best.select(*keys, F.col("_b.len").alias(name), F.col("_b._s").alias("win_start"),
                       F.col("_b._e").alias("win_end"))


def min_item_distance(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: str, a, b,
                      name: str = "min_distance") -> DataFrame:
    """Least position distance between an ``a`` row and a ``b`` row per key."""
    r = row_index(df, keys, order, name="_pos")
    s = ordered_scan(r, keys, order, [Agg("_la", "last", F.when(F.col(item) == a, F.col("_pos"))),
                                      Agg("_lb", "last", F.when(F.col(item) == b, F.col("_pos")))])
    d = F.when(F.col(item) == a, F.col("_pos") - F.col("_lb")).when(F.col(item) == b, F.col("_pos") - F.col("_la"))
    return s.groupBy(*keys).agg(F.min(d).alias(name)).where(F.col(name).isNotNull())


def ordered_funnel(df: DataFrame, keys: Sequence[str], t: str, step_col: str, steps: Sequence[str],
                   name: str = "steps_done") -> DataFrame:
    """How many steps occur in order (not necessarily adjacent) per key: the
    first time of step 1, then the first time of step 2 after it, ..."""
    reached = None
    for i, s in enumerate(steps):
        rows = df.where(F.col(step_col) == s).select(*keys, F.col(t).alias("_t"))
        if reached is not None:
            rows = key_join(rows, reached, keys).where(F.col("_t") > F.col("_prev"))
        reached = rows.groupBy(*keys).agg(F.min("_t").alias("_prev")).withColumn(f"_s{i}", F.lit(1))
        if i == 0:
            acc = reached.select(*keys, F.lit(1).alias(name))
        else:
            acc = key_join(acc, reached.select(*keys, F.lit(1).alias("_hit")), keys, "left") \
                .select(*keys, (F.col(name) + F.coalesce("_hit", F.lit(0))).alias(name))
        reached = reached.select(*keys, "_prev")
    allk = df.select(*keys).distinct()
    return key_join(allk, acc, keys, "left").fillna(0, [name]).withColumn(
        "complete", F.col(name) == len(steps))


def assign_unique_slots(df: DataFrame, keys: Sequence[str], val: str, id_col: str,
                        name: str = "slot") -> DataFrame:
    """Least total increment making all values of a key distinct: sorted,
    slot_i = max(v_j - j for j <= i) + i."""
    a = row_index(df, keys, [val, id_col], name="_r")
    b = ordered_scan(a, keys, [val, id_col], [Agg("_m", "max", F.col(val) - F.col("_r"))])
    return b.select(*df.columns, (F.col("_m") + F.col("_r")).alias(name))


# ---------------------------------------------------------------- intervals

def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Union of closed spans per key; touching spans merge."""
    a = ordered_scan(df.select(*keys, start, end), keys, [start, end],
                     [Agg("_me", "max", F.col(end), exclusive=True)])
    flag = F.when(F.col("_me").isNull() | (F.col(start) > F.col("_me")), 1).otherwise(0)
    b = ordered_scan(a.withColumn("_f", flag), keys, [start, end], [Agg("_isl", "sum", F.col("_f"))])
    return b.groupBy(*keys, "_isl").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_isl")


def interval_conflicts(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Per key: any two spans overlapping (touching is fine) and the most
    spans open at once (half-open: an end before a start at equal time)."""
    a = ordered_scan(df.select(*keys, start, end), keys, [start, end],
                     [Agg("_me", "max", F.col(end), exclusive=True)])
    conflict = a.groupBy(*keys).agg(F.max(F.coalesce(F.col(start) < F.col("_me"), F.lit(False))).alias("has_conflict"))
    ev = (df.select(*keys, F.col(start).alias("_t"), F.lit(1).alias("_d"))
          .unionAll(df.select(*keys, F.col(end).alias("_t"), F.lit(-1).alias("_d"))))
    ev = ev.groupBy(*keys, "_t").agg(F.sum(F.when(F.col("_d") < 0, F.col("_d")).otherwise(0)).alias("_down"),
                                     F.sum(F.when(F.col("_d") > 0, F.col("_d")).otherwise(0)).alias("_up"))
    # ends first at an equal time: the peak at t is (running total before t) + downs + ups
    s = ordered_scan(ev.withColumn("_net", F.col("_down") + F.col("_up")), keys, ["_t"],
                     [Agg("_run", "sum", F.col("_net"))])
    peak = s.groupBy(*keys).agg(F.max("_run").alias("max_concurrent"))
    return key_join(conflict, peak, keys)


# ---------------------------------------------------------------- rate limit

def rate_limit(df: DataFrame, keys: Sequence[str], t: str, id_col: str, span, max_rounds: int = 64) -> DataFrame:
    """Allow a row when its time is at least ``span`` after the last ALLOWED
    row of its key (``id_col`` unique in the table).

    The allowed rows are the chain first row -> next -> next ..., where
    next(i) is the first row at or after t_i + span (an as-of lookup).  The
    chain is marked by pointer doubling: after round j the marked set holds
    the first 2^j chain rows, so a chain of n rows takes log2(n) rounds of
    joins on the unique id -- no key is ever processed by one task."""
    from ..plans.loops import check_cap, materialize
    base = df.select(*keys, t, id_col)
    probes = base.select(*keys, id_col, (F.col(t) + span).alias("_probe"))
    right = base.select(*keys, F.col(t).alias("_rt"), F.col(id_col).alias("_nid"), (-F.col(id_col)).alias("_seq"))
    nxt = asof_lookup(probes, right, keys, F.col("_probe"), F.col("_rt"), ["_nid"], direction="forward",
                      right_seq="_seq")
    jump = materialize(nxt.where(F.col("_nid").isNotNull()).select(F.col(id_col).alias("x"), F.col("_nid").alias("y")))
    first = base.groupBy(*keys).agg(F.min_by(id_col, F.struct(t, id_col)).alias("x"))
    marked = materialize(first.select("x"))
    size = marked.count()
    r = 0
    while True:
        check_cap(r, max_rounds, "rate_limit")
        r += 1
        step = marked.join(jump, "x").select(F.col("y").alias("x"))
        grown = materialize(marked.unionByName(step).distinct())
        n = grown.count()
        if n == size:
            break
        marked, size = grown, n
        j2 = jump.select(F.col("x").alias("_m"), F.col("y").alias("_y2"))
        jump = materialize(jump.join(j2, jump["y"] == j2["_m"]).select("x", F.col("_y2").alias("y")))
    flags = marked.select(F.col("x").alias(id_col), F.lit(True).alias("allowed"))
    return base.join(flags, id_col, "left").fillna(False, ["allowed"])
