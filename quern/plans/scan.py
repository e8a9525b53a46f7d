"""Skew-safe running aggregates over an ordered series.

``Window.partitionBy(key).orderBy(pos)`` sends every row of a key to one
task; when one key holds a third of the data, that task holds a third of the
data.  ``ordered_scan`` keeps that window for keys of at most ``chunk_rows``
rows and splits the larger ones by rank of the whole order tuple:

1. rows per key are counted (partial aggregate).  A key is *hot* when its
   count is above ``max(chunk_rows, total / max_hot_keys)``, so there are
   fewer than ``max_hot_keys`` hot keys: that table has a proven size bound
   and is broadcast;
2. rows of hot keys are range-partitioned by (keys, order, row id) into as
   many partitions as their number of rows asks for.  The partitioner cuts by
   rank, so outlying, tied, null or text values change nothing; the row id
   splits even rows whose order values are all equal.  The result is written
   once (``checkpoint()``) with its partition number, so every reader, and
   every re-computation after a lost executor, sees the same cuts;
3. one window keyed by (keys, partition) computes the running aggregate
   inside each piece;
4. totals per piece (a partial aggregate, one row per key and partition: at
   most ``max_hot_keys`` plus the number of partitions) become a carry-in per
   piece, broadcast back.

A table without keys is one series and is split in the same way above
``UNKEYED_ROWS`` rows.  A derived input is checkpointed once (see
:func:`reusable`) so chained scans stay linear in work and in plan size.

Supported operations (associative): ``sum``, ``count``, ``min``, ``max``, ``xor``,
``last`` (last non-null value), ``first`` (first non-null value).  Pass
``struct(col)`` to ``last`` for a null-preserving "previous row" value.

Order: a list of columns of any type, all ascending, or all descending with
``descending=True``.  The order should be unique within a key (add an id last)
for deterministic ``last``/``first``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .loops import materialize

_CH = "_scan_chunk"
_TIE = "_scan_tie"

DEFAULT_CHUNK_ROWS = 2_000_000
DEFAULT_MAX_HOT_KEYS = 50_000
UNKEYED_ROWS = 200_000


@dataclass(frozen=True)
class Agg:
    """One running aggregate: output column, operation and input expression."""

    name: str
    op: str
    expr: Column
    exclusive: bool = False  # frame ends at the previous row instead of this one


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _window_agg(op: str, e: Column) -> Column:
    if op == "sum":
        return F.sum(e)
    if op == "count":
        return F.count(e)
    if op == "min":
        return F.min(e)
    if op == "max":
        return F.max(e)
    if op == "last":
        return F.last(e, ignorenulls=True)
    if op == "first":
        return F.first(e, ignorenulls=True)
    if op == "xor":
        return F.bit_xor(e)
    raise ValueError(f"unsupported scan op {op!r}")


def _total_agg(op: str, e: Column, order_key: Column, descending: bool) -> Column:
    """Aggregate of one whole chunk (plain group-by, partial aggregation)."""
    if op in ("sum", "count", "min", "max", "xor"):
        return _window_agg(op, e)
    ok = F.when(e.isNotNull(), order_key)
    pick_max = (op == "last") != descending
    return F.max_by(e, ok) if pick_max else F.min_by(e, ok)


def _carry_agg(op: str, e: Column) -> Column:
    if op in ("sum", "count"):
        return F.sum(e)
    return _window_agg(op, e)


def _combine(op: str, local: Column, carry: Column) -> Column:
    if op == "sum":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)
    if op == "count":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    if op == "min":
        return F.least(local, carry)
    if op == "max":
        return F.greatest(local, carry)
    if op == "last":
        return F.coalesce(local, carry)
    if op == "first":
        return F.coalesce(carry, local)
    if op == "xor":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local.bitwiseXOR(carry))
    raise ValueError(op)


def _conf_int(spark, key: str, default: int) -> int:
    try:
        v = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001
        v = None
    return int(v) if v else default


_DERIVED = ("Join", "Aggregate", "Window", "Union", "Repartition", "Expand", "Generate", "Sort",
            "Distinct", "Intersect", "Except", "Sample")


def reusable(df: DataFrame) -> DataFrame:
    """Materialize ``df`` when it is a derived result that several branches read.

    The scan reads its input in several branches (key statistics, chunk
    totals, the window).  Re-reading parquet is cheap, but a derived input (a
    join, an earlier scan) would be re-run in every branch, and chained scans
    would multiply both the work and the size of the plan.  The input is
    written once with ``checkpoint()`` to the shared checkpoint folder: the
    plan below becomes a leaf, the data survives lost executors, and every
    branch reads the same rows."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if not any(tok in plan for tok in _DERIVED):
        return df
    return materialize(df)


def _keys_equal(keys: Sequence[str], prefix: str) -> Column:
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
        cond = e if cond is None else cond & e
    return cond


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence, aggs: Iterable[Agg],
                 descending: bool = False, chunk_rows: int | None = None,
                 max_hot_keys: int | None = None) -> DataFrame:
    """Add running aggregates per key in ``order`` to every row of ``df``.

    ``keys`` may be empty: the whole table is one series."""
    aggs = list(aggs)
    keys = list(keys)
    spark = df.sparkSession
    chunk_rows = chunk_rows or _conf_int(spark, "quern.scan.chunkRows", DEFAULT_CHUNK_ROWS)
    max_hot = max_hot_keys or _conf_int(spark, "quern.scan.maxHotKeys", DEFAULT_MAX_HOT_KEYS)
    df = reusable(df)
    if not keys:
        total = df.count()
        limit = max(min(chunk_rows, UNKEYED_ROWS), -(-total // max_hot))
        if total <= limit:
            return _whole(df, keys, order, aggs, descending)
        return _split(df, keys, order, aggs, descending, -(-total // limit))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    total, largest = counts.agg(F.sum("_cnt"), F.max("_cnt")).first()
    limit = max(chunk_rows, -(-(total or 0) // max_hot))
    if (largest or 0) <= limit:
        return _whole(df, keys, order, aggs, descending)
    # Fewer than max_hot keys have more than total / max_hot rows: a bounded broadcast.
    hot = materialize(counts.where(F.col("_cnt") > limit).select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_cnt"))
    rows = hot.agg(F.sum("_cnt")).first()[0]
    is_hot = _keys_equal(keys, "_h_")
    heavy = df.join(F.broadcast(hot.drop("_cnt")), is_hot, "left_semi")
    light = df.join(F.broadcast(hot.drop("_cnt")), is_hot, "left_anti")
    return (_split(heavy, keys, order, aggs, descending, -(-rows // limit))
            .unionByName(_whole(light, keys, order, aggs, descending)))


def _running(part: Sequence[str], sort_cols: list[Column], aggs: list[Agg]) -> list[Column]:
    seg = Window.partitionBy(*part).orderBy(*sort_cols)
    incl = seg.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    excl = seg.rowsBetween(Window.unboundedPreceding, -1)
    return [_window_agg(a.op, a.expr).over(excl if a.exclusive else incl) for a in aggs]


def _whole(df: DataFrame, keys: list[str], order: Sequence, aggs: list[Agg], descending: bool) -> DataFrame:
    """One plain window per key (each of a bounded number of rows)."""
    sort_cols = [_col(o).desc() if descending else _col(o) for o in order]
    return df.select("*", *[c.alias(a.name) for a, c in zip(aggs, _running(keys, sort_cols, aggs))])


def _split(df: DataFrame, keys: list[str], order: Sequence, aggs: list[Agg], descending: bool, pieces: int) -> DataFrame:
    """Pieces of equal numbers of rows by rank, windows inside them, carry-ins."""
    order_cols = [*[_col(o) for o in order], F.col(_TIE)]
    sort_cols = [c.desc() for c in order_cols] if descending else order_cols
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    ranged = materialize(tied.repartitionByRange(pieces + 1, *[F.col(k) for k in keys], *sort_cols)
                         .withColumn(_CH, F.spark_partition_id().cast("long")))
    local = ranged.select("*", *[c.alias(f"_run_{a.name}") for a, c in zip(aggs, _running([*keys, _CH], sort_cols, aggs))])
    okey = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_cols)])
    totals = (ranged.groupBy(*keys, _CH)
              .agg(*[_total_agg(a.op, a.expr, okey, descending).alias(f"_tot_{a.name}") for a in aggs]))
    before = Window.partitionBy(*keys).orderBy(_CH).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col(_CH).alias("_c_ch"),
                          *[_carry_agg(a.op, F.col(f"_tot_{a.name}")).over(before).alias(f"_car_{a.name}") for a in aggs])
    cond = F.col(_CH) == F.col("_c_ch")
    if keys:
        cond = cond & _keys_equal(keys, "_c_")
    # One row per key and piece: fewer than max_hot keys plus the number of pieces.
    joined = local.join(F.broadcast(carry), cond, "left")
    return joined.select(*df.columns, *[_combine(a.op, F.col(f"_run_{a.name}"), F.col(f"_car_{a.name}")).alias(a.name) for a in aggs])


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "rn",
              descending: bool = False, **kw) -> DataFrame:
    """1-based row number per key in ``order`` (skew-safe)."""
    return ordered_scan(df, keys, order, [Agg(name, "count", F.lit(1))], descending=descending, **kw)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str],
             prefix: str = "prev_", descending: bool = False, **kw) -> DataFrame:
    """Values of the previous row per key (``lag(1)``; with ``descending`` the
    next row, ``lead(1)``), null on the first row."""
    aggs = [Agg(f"_prevs_{c}", "last", F.struct(F.col(c).alias("v")), exclusive=True) for c in cols]
    out = ordered_scan(df, keys, order, aggs, descending=descending, **kw)
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_prevs_{c}")["v"]).drop(f"_prevs_{c}")
    return out
