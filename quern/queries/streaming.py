"""Stream operators bound to the driver tables (survey 2.5 rate limit, 2.12).

Each stream query feeds the events file (or bookings derived from orders,
written once to the shared scratch folder) through a file stream with an
``availableNow`` trigger into a parquet sink and returns the sink; the
oracle is the batch rule in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sequences as sq
from ..sources.csv import scratch_path
from ..sources.tables import table
from ..streaming import operators as so
from ..streaming.runner import file_stream, run_to_table
from .registry import query
from .sequences import DAY_US, E, S, spans

SPAN_US = 3 * DAY_US

_RATE_SQL = f"""
WITH RECURSIVE e AS (SELECT user_id, event_type, event_id, epoch_us(ts) AS t, epoch_us(ts) + {SPAN_US} AS t2 FROM events),
nx AS (SELECT a.event_id, (SELECT arg_min(b.event_id, b.t) FROM e b WHERE b.user_id = a.user_id
                           AND b.event_type = a.event_type AND b.t >= a.t2) AS nid FROM e a),
fi AS (SELECT arg_min(event_id, t) AS event_id FROM e GROUP BY user_id, event_type),
chain(event_id) AS (SELECT event_id FROM fi UNION ALL
                    SELECT nx.nid FROM chain JOIN nx ON nx.event_id = chain.event_id WHERE nx.nid IS NOT NULL)
SELECT e.user_id, e.event_type, e.event_id, e.event_id IN (SELECT event_id FROM chain) AS allowed FROM e"""


@query("rate_limit", _RATE_SQL)
def q_rate_limit(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "event_id",
                                         F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    r = sq.rate_limit(e, ["user_id", "event_type"], "us", "event_id", SPAN_US)
    return r.select("user_id", "event_type", "event_id", "allowed")


def _event_stream(spark, d):
    s = file_stream(spark, f"{d}/events.parquet")
    return s.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type",
                    F.round(F.col("value") * 100).cast("long").alias("cents"),
                    F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))


@query("stream_rate_limit", _RATE_SQL.replace(" AS allowed FROM e", " AS allowed, false AS late FROM e"))
def q_stream_rate_limit(spark, d):
    s = _event_stream(spark, d)
    out = so.stream_rate_limit(s, ["user_id", "event_type"], "us", "event_id", SPAN_US)
    return run_to_table(out, "stream-rate-limit").select("user_id", "event_type", "event_id", "allowed", "late")


@query("stream_moving_average", f"""
SELECT user_id, event_id, avg(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                           ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg FROM {E}""")
def q_stream_moving_average(spark, d):
    s = _event_stream(spark, d)
    out = so.stream_moving_average(s, ["user_id"], ["us", "event_id"], "event_id", "cents", 3)
    return run_to_table(out, "stream-moving-average")


@query("stream_recent_count", f"""
SELECT user_id, event_id,
       count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {DAY_US} PRECEDING AND CURRENT ROW) AS recent
FROM {E}""")
def q_stream_recent_count(spark, d):
    s = _event_stream(spark, d)
    out = so.stream_recent_count(s, ["user_id"], "us", "event_id", DAY_US)
    return run_to_table(out, "stream-recent-count")


@query("stream_kth_largest", f"""
WITH e AS {E}
SELECT a.user_id, a.event_id, CAST(list_sort(list(b.cents), 'DESC')[least(3, count(*))] AS DOUBLE) AS kth_largest
FROM e a JOIN e b ON b.user_id = a.user_id AND (b.ts < a.ts OR (b.ts = a.ts AND b.event_id <= a.event_id))
GROUP BY a.user_id, a.event_id""")
def q_stream_kth_largest(spark, d):
    s = _event_stream(spark, d)
    out = so.stream_kth_largest(s, ["user_id"], ["us", "event_id"], "event_id", "cents", 3)
    return run_to_table(out, "stream-kth-largest")


# The events feed read as a key-value log: purchase = put(cents), error =
# remove, view = get; other types do not touch the store.
_OP = "CASE event_type WHEN 'purchase' THEN 'put' WHEN 'error' THEN 'remove' WHEN 'view' THEN 'get' END"


def _op_col():
    return (F.when(F.col("event_type") == "purchase", "put").when(F.col("event_type") == "error", "remove")
            .when(F.col("event_type") == "view", "get"))


@query("stream_latest_value", f"""
WITH e AS (SELECT user_id, event_id, ts, cents, {_OP} AS op FROM {E}),
g AS (SELECT user_id, event_id, op, last(CASE WHEN op = 'put' THEN cents WHEN op = 'remove' THEN -1 END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v FROM e)
SELECT user_id, event_id, coalesce(v, -1) AS value FROM g WHERE op = 'get'""")
def q_stream_latest_value(spark, d):
    s = _event_stream(spark, d).withColumn("op", _op_col())
    out = so.stream_latest_value(s, ["user_id"], ["us", "event_id"], "event_id", "op", "cents")
    return run_to_table(out, "stream-latest-value")


@query("latest_value", f"""
WITH e AS (SELECT user_id, event_id, ts, cents, {_OP} AS op FROM {E}),
l AS (SELECT user_id, arg_max(op, (ts, event_id)) AS op, arg_max(cents, (ts, event_id)) AS v FROM e
      WHERE op IN ('put', 'remove') GROUP BY user_id)
SELECT user_id, v AS value FROM l WHERE op = 'put'""")
def q_latest_value(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type",
                                         F.round(F.col("value") * 100).cast("long").alias("cents"))
    return so.latest_value_batch(e.withColumn("op", _op_col()), ["user_id"], ["ts", "event_id"], "op", "cents")


@query("recently_used_keys", """
SELECT user_id FROM (SELECT user_id, max(ts) AS t, arg_max(event_id, (ts, event_id)) AS i FROM events GROUP BY 1)
ORDER BY t DESC, i DESC, user_id LIMIT 10""")
def q_recently_used_keys(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    return so.recently_used_keys(e, ["user_id"], ["ts", "event_id"], 10)


@query("stream_max_overlap", f"""
WITH s AS {S},
a AS (SELECT DISTINCT b.o_custkey, b.o_orderkey, b.st AS bst, p.st AS pt FROM s b JOIN s p ON p.o_custkey = b.o_custkey
      AND (p.st < b.st OR (p.st = b.st AND p.o_orderkey <= b.o_orderkey))),
c AS (SELECT a.o_custkey, a.o_orderkey, a.pt, count(q.o_orderkey) AS n FROM a LEFT JOIN s q ON q.o_custkey = a.o_custkey
      AND (q.st < a.bst OR (q.st = a.bst AND q.o_orderkey <= a.o_orderkey)) AND q.st <= a.pt AND a.pt < q.en
      GROUP BY a.o_custkey, a.o_orderkey, a.pt)
SELECT o_custkey, o_orderkey, CAST(max(n) AS BIGINT) AS max_overlap FROM c GROUP BY o_custkey, o_orderkey""")
def q_stream_max_overlap(spark, d):
    bookings = scratch_path(spark, "bookings")
    spans(spark, d).write.mode("overwrite").parquet(bookings)
    s = file_stream(spark, bookings, max_files=1000)
    out = so.stream_max_overlap(s, ["o_custkey"], ["st", "o_orderkey"], "o_orderkey", "st", "en")
    return run_to_table(out, "stream-max-overlap")
