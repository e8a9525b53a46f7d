"""Stateful stream operators (survey 2.12).

Each operator is ``applyInPandasWithState`` over hash buckets of keys, with
small, bounded state per key in the RocksDB state store (checkpointed every
micro-batch): a last time, the last n values, the k largest values, the
times inside the span, or the held intervals of one key.  Inside a
micro-batch a key's rows are sorted by the order column; across batches the
feed is taken in arrival order (as the reference assumes).  The rate limit
runs in event time: a row behind the watermark is not applied to the state
and comes out marked ``late`` (so late rows are counted, never silently
change a key).
Per-key state is removed by event-time timeouts (rate limit) or stays bounded
by n, k or the span; the overlap operator keeps the distinct ends of a key's
spans, which grow with the key's bookings.
"""

from __future__ import annotations

import heapq
import math
import pickle
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 1024  # of keys; part of a stream's checkpoint, so the same in every restart


def use_rocksdb(spark) -> None:
    """State in RocksDB, not in the executors' heaps."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _in_order(cols: dict[str, np.ndarray], order: Sequence[str], first: np.ndarray | None = None) -> np.ndarray:
    """Places of the rows by ``first`` and ``order``; nulls last, ties as they came."""
    if any(cols[c].dtype == object for c in order):
        by = pd.DataFrame({c: cols[c] for c in order})
        by.insert(0, "_first", 0 if first is None else first)
        return by.sort_values(list(by.columns), kind="mergesort").index.to_numpy()
    return np.lexsort([cols[c] for c in reversed(order)] + ([] if first is None else [first]))


class Processor:
    """One key's rule: ``step`` takes the key's rows of a micro-batch in order,
    the state (None: none) and the watermark (ms), and returns the result's
    columns and the new state.  ``handleInputRows`` runs it on one key's frames."""

    order: list[str]

    def init(self, handle) -> None:
        self.state = handle.getValueState("state", "state binary")

    def step(self, cols: dict[str, np.ndarray], state: tuple | None, wm: int) -> tuple[dict, tuple | None]:
        raise NotImplementedError

    def due_ms(self, state: tuple) -> int | None:
        """Watermark from which the state tells nothing any more."""
        return None

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows), ignore_index=True)
        cols = {c: pdf[c].to_numpy() for c in pdf.columns}
        at = _in_order(cols, self.order)
        out, state = self.step({c: v[at] for c, v in cols.items()}, self.state.get(),
                               timerValues.getCurrentWatermarkInMs() if timerValues else 0)
        self.state.update(state)
        yield pd.DataFrame({**{k: [v] * len(out[self.id]) for k, v in zip(self.keys, key)}, **out})


def _by_key(stream: DataFrame, reads: Sequence[str], processor: Processor, out: str, event_time: bool = False,
            buckets: int = BUCKETS) -> DataFrame:
    """``processor`` over the columns ``reads`` of each key of a micro-batch.

    A call of Python for each key costs more than the key's rows do, so the
    groups of the stream are ``buckets`` hash buckets of keys: a bucket's state
    is the states of its keys by key, and its timeout the first of theirs.
    Keys go as text (exact, and null stays null beside numbers)."""
    keys = processor.keys
    names = [f"_key{i}" for i in range(len(keys))]
    reads = list(dict.fromkeys(reads))
    rows = stream.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"),
                         *[F.col(k).cast("string").alias(n) for k, n in zip(keys, names)], *reads)

    def run(bucket, frames, group):
        held = pickle.loads(bytes(group.get[0])) if group.exists else {}
        wm = max(group.getCurrentWatermarkMs(), 0) if event_time else 0
        parts = [] if group.hasTimedOut else list(frames)
        if parts:
            pdf = pd.concat(parts, ignore_index=True)
            code = pdf.groupby(names, sort=False, dropna=False).ngroup().to_numpy()
            cols = {c: pdf[c].to_numpy() for c in [*names, *reads]}
            at = _in_order(cols, processor.order, code)
            cols, code = {c: v[at] for c, v in cols.items()}, code[at]
            ends = [*(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
            given, start = [], 0
            for end in ends:
                key = tuple(None if pd.isna(cols[n][start]) else cols[n][start] for n in names)
                found, state = processor.step({c: cols[c][start:end] for c in reads}, held.get(key), wm)
                if state is None:
                    held.pop(key, None)
                else:
                    held[key] = state
                given.append((key, found))
                start = end
            lengths = [len(found[processor.id]) for _, found in given]
            yield pd.DataFrame({**{n: [key[i] for (key, _), m in zip(given, lengths) for _ in range(m)]
                                   for i, n in enumerate(names)},
                                **{c: np.concatenate([found[c] for _, found in given]) for c in given[0][1]}})
        first = None
        if event_time:
            due = {key: processor.due_ms(state) for key, state in held.items()}
            held = {key: state for key, state in held.items() if due[key] > wm}
            first = min((due[key] for key in held), default=None)
        if held:
            group.update((pickle.dumps(held, 5),))
            if first is not None:
                group.setTimeoutTimestamp(first)
        elif group.exists:
            group.remove()

    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = ", ".join([*[f"{n} string" for n in names], out])
    got = rows.groupBy("_bucket").applyInPandasWithState(
        run, schema, "held binary", "append",
        GroupStateTimeout.EventTimeTimeout if event_time else GroupStateTimeout.NoTimeout)
    return got.select(*[F.col(n).cast(types[k]).alias(k) for k, n in zip(keys, names)],
                      *[c for c in got.columns if c not in names])


class RateLimitProcessor(Processor):
    """Allow a row when its time is at least ``span`` after the last ALLOWED
    row of its key.  State: the last allowed time, until the watermark is at
    last + span (any later row is allowed anyway)."""

    def __init__(self, keys, t, id_col, span_us):
        self.keys, self.t, self.id, self.span = list(keys), t, id_col, int(span_us)
        self.order = [t, id_col]

    def step(self, cols, state, wm):
        times = cols[self.t]
        # rows behind the watermark are not applied to the state: marked late
        late = (times < wm * 1000) if wm and wm > 0 else np.zeros(len(times), dtype=bool)
        last = None if state is None else state[0]
        allowed = np.zeros(len(times), dtype=bool)
        for i, t in enumerate(times.tolist()):
            if not late[i] and (last is None or t >= last + self.span):
                allowed[i] = True
                last = int(t)
        out = {self.id: cols[self.id], self.t: times, "allowed": allowed, "late": late}
        return out, None if last is None else (last,)

    def due_ms(self, state):
        return math.ceil((state[0] + self.span) / 1000)


class MovingAverageProcessor(Processor):
    """Mean of the last n arrivals; state: those n values."""

    def __init__(self, keys, order, id_col, val, n):
        self.keys, self.order, self.id, self.val, self.n = list(keys), list(order), id_col, val, int(n)

    def step(self, cols, state, wm):
        held = state[0] if state is not None else np.array([], dtype=float)
        vals = np.concatenate([held, cols[self.val].astype(float)])
        padded = np.concatenate([np.full(self.n - 1, np.nan), vals])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.n)[len(held):]
        seen = np.count_nonzero(~np.isnan(windows), axis=1)  # null values are no part of a mean
        means = np.where(seen > 0, np.nansum(windows, axis=1) / np.maximum(seen, 1), np.nan)
        return {self.id: cols[self.id], "moving_avg": means}, (vals[-self.n:].copy(),)


class RecentCountProcessor(Processor):
    """Arrivals within [t - span, t] at each arrival; state: the times still
    inside the span."""

    def __init__(self, keys, t, id_col, span):
        self.keys, self.t, self.id, self.span = list(keys), t, id_col, int(span)
        self.order = [t, id_col]

    def step(self, cols, state, wm):
        held = state[0] if state is not None else np.array([], dtype=np.int64)
        t = cols[self.t].astype(np.int64)  # ascending
        # held rows in [t - span, t] (a held row may be later than t: files out
        # of order), and the batch's own rows up to this one
        counts = (np.searchsorted(held, t, "right") - np.searchsorted(held, t - self.span, "left")
                  + np.arange(1, len(t) + 1) - np.searchsorted(t, t - self.span, "left"))
        seen = np.sort(np.concatenate([held, t]))
        return {self.id: cols[self.id], "recent": counts}, (seen[seen >= seen[-1] - self.span],)


class KthLargestProcessor(Processor):
    """k-th largest value after each arrival (the smallest held while fewer
    than k arrived); state: the k largest values."""

    def __init__(self, keys, order, id_col, val, k):
        self.keys, self.order, self.id, self.val, self.k = list(keys), list(order), id_col, val, int(k)

    def step(self, cols, state, wm):
        held = list(state[0]) if state is not None else []
        heapq.heapify(held)
        vals = cols[self.val].astype(float).tolist()
        res = np.empty(len(vals))
        for i, v in enumerate(vals):
            if len(held) < self.k:
                heapq.heappush(held, v)
            elif v > held[0]:
                heapq.heapreplace(held, v)
            res[i] = held[0]
        return {self.id: cols[self.id], "kth_largest": res}, (held,)


class LatestValueProcessor(Processor):
    """Key-value store fed by a log of put / remove / get operations: the
    last write wins, remove deletes, a get returns the value or -1."""

    def __init__(self, keys, order, id_col, op, val):
        self.keys, self.order, self.id, self.op, self.val = list(keys), list(order), id_col, op, val

    def step(self, cols, state, wm):
        cur = None if state is None else state[0]
        ids, vals = [], []
        for op, v, rid in zip(cols[self.op], cols[self.val], cols[self.id]):
            if op == "put":
                cur = int(v)
            elif op == "remove":
                cur = None
            elif op == "get":
                ids.append(rid)
                vals.append(-1 if cur is None else cur)
        return ({self.id: np.array(ids, dtype=np.int64), "value": np.array(vals, dtype=np.int64)},
                None if cur is None else (cur,))


class MaxOverlapProcessor(Processor):
    """Most bookings open at once (half-open spans) after each booking; state:
    the key's span ends in order with the number of spans open from each, and
    the most so far.  A booking only raises the counts between its own ends."""

    def __init__(self, keys, order, id_col, start, end):
        self.keys, self.order, self.id, self.start, self.end = list(keys), list(order), id_col, start, end

    def step(self, cols, state, wm):
        start, end = (cols[c].astype(np.int64) for c in (self.start, self.end))
        live = start < end  # an empty or inverted span holds nothing
        old = state[0] if state is not None else np.array([], dtype=np.int64)
        at = np.unique(np.concatenate([old, start[live], end[live]]))
        count = np.zeros(len(at), dtype=np.int64)
        if len(old):  # a new end takes over the count of the segment it falls in
            k = np.searchsorted(old, at, "right") - 1
            count = np.where(k >= 0, state[1][np.maximum(k, 0)], 0)
        most = state[2] if state is not None else 0
        res = np.empty(len(start), dtype=np.int64)
        lo, hi = np.searchsorted(at, start).tolist(), np.searchsorted(at, end).tolist()
        for i, holds in enumerate(live.tolist()):
            if holds:
                count[lo[i]:hi[i]] += 1
                most = max(most, int(count[lo[i]:hi[i]].max()))
            res[i] = most
        return {self.id: cols[self.id], "max_overlap": res}, (at, count, most)


def stream_rate_limit(stream: DataFrame, keys: Sequence[str], t_us: str, id_col: str, span_us: int,
                      lateness: str = "1 hour", ts: str = "ts") -> DataFrame:
    return _by_key(stream.withWatermark(ts, lateness), [ts, t_us, id_col], RateLimitProcessor(keys, t_us, id_col, span_us),
                   f"{id_col} long, {t_us} long, allowed boolean, late boolean", event_time=True)


def stream_moving_average(stream: DataFrame, keys: Sequence[str], order: Sequence[str], id_col: str, val: str,
                          n: int) -> DataFrame:
    return _by_key(stream, [*order, id_col, val], MovingAverageProcessor(keys, order, id_col, val, n),
                   f"{id_col} long, moving_avg double")


def stream_recent_count(stream: DataFrame, keys: Sequence[str], t: str, id_col: str, span: int) -> DataFrame:
    return _by_key(stream, [t, id_col], RecentCountProcessor(keys, t, id_col, span), f"{id_col} long, recent long")


def stream_kth_largest(stream: DataFrame, keys: Sequence[str], order: Sequence[str], id_col: str, val: str,
                       k: int) -> DataFrame:
    return _by_key(stream, [*order, id_col, val], KthLargestProcessor(keys, order, id_col, val, k),
                   f"{id_col} long, kth_largest double")


def stream_latest_value(stream: DataFrame, keys: Sequence[str], order: Sequence[str], id_col: str, op: str,
                        val: str) -> DataFrame:
    return _by_key(stream, [*order, id_col, op, val], LatestValueProcessor(keys, order, id_col, op, val),
                   f"{id_col} long, value long")


def stream_max_overlap(stream: DataFrame, keys: Sequence[str], order: Sequence[str], id_col: str, start: str,
                       end: str) -> DataFrame:
    return _by_key(stream, [*order, id_col, start, end], MaxOverlapProcessor(keys, order, id_col, start, end),
                   f"{id_col} long, max_overlap long")


def latest_value_batch(log: DataFrame, keys: Sequence[str], order: Sequence[str], op: str, val: str) -> DataFrame:
    """Batch form: change-log compaction.  The last put/remove per key wins;
    keys whose last operation is a remove are gone."""
    w = log.where(F.col(op).isin("put", "remove"))
    last = w.groupBy(*keys).agg(F.max_by(F.struct(F.col(op).alias("op"), F.col(val).alias("v")),
                                         F.struct(*order)).alias("_l"))
    return last.where(F.col("_l.op") == "put").select(*keys, F.col("_l.v").alias("value"))


def recently_used_keys(log: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Capacity form: the n keys touched most recently (any operation)."""
    last = log.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_t"))
    return last.orderBy(F.col("_t").desc(), *[F.col(k) for k in keys]).limit(n).select(*keys)


def _pickle_by_value() -> None:
    """Ship the processor classes by value: the Python processes that run
    them (driver-side stream runner and executors) need not import quern."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_pickle_by_value()
