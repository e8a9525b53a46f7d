"""Window and sequence operators bound to the driver tables (survey 2.5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sequences as sq
from ..sources.tables import table
from .registry import query

DAY_US = 86_400_000_000
ORDER = ["ts", "event_id"]


def events(spark, d):
    """events with integer cents and epoch microseconds."""
    e = table(spark, d, "events")
    return e.select("user_id", "event_id", "ts", "event_type",
                    F.round(F.col("value") * 100).cast("long").alias("cents"),
                    F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))


E = """(SELECT user_id, event_id, ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
        epoch_us(ts) AS us FROM events)"""
W = "PARTITION BY user_id ORDER BY ts, event_id"


def lines(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.col("l_quantity").cast("long").alias("q"), "l_extendedprice")


L = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS q, l_extendedprice
        FROM lineitem)"""
# line numbers repeat inside an order in the driver tables: this is a total order
LORDER = ["l_linenumber", "l_partkey", "l_suppkey", "q", "l_extendedprice"]
LO = "l_linenumber, l_partkey, l_suppkey, q, l_extendedprice"


def spans(spark, d):
    """Order date to last ship date, as day numbers, per order."""
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_ship"))
    day = lambda c: F.unix_date(F.to_date(c)).cast("long")
    return o.join(li, o.o_orderkey == li.l_orderkey).select(
        "o_custkey", "o_orderkey", day("o_orderdate").alias("st"), day("_ship").alias("en"))


S = """(SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS st,
        CAST(CAST(max(l_shipdate) AS DATE) - DATE '1970-01-01' AS BIGINT) AS en
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey, o_orderdate)"""


def order_days(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_custkey", "o_orderkey", F.unix_date(F.to_date("o_orderdate")).cast("long").alias("day"))


OD = """(SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS day FROM orders)"""


@query("running_sum", f"""
SELECT user_id, event_id, CAST(sum(cents) OVER ({W} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM {E}""")
def q_running_sum(spark, d):
    return sq.running_sum(events(spark, d), ["user_id"], ORDER, "cents").select("user_id", "event_id", "running")


@query("running_sum_global", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(sum(q) OVER (ORDER BY l_orderkey, {LO} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM {L}""")
def q_running_sum_global(spark, d):
    return sq.running_sum(lines(spark, d), [], ["l_orderkey", *LORDER], "q").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "running")


@query("running_xor", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       bit_xor(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {LO} ROWS UNBOUNDED PRECEDING) AS running
FROM {L}""")
def q_running_xor(spark, d):
    return sq.running_sum(lines(spark, d), ["l_orderkey"], LORDER, "l_partkey", op="xor").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "running")


@query("greater_sum", f"""
SELECT l_orderkey, l_linenumber,
       CAST(sum(q) OVER (PARTITION BY l_orderkey ORDER BY q DESC RANGE UNBOUNDED PRECEDING) AS BIGINT) AS greater_sum
FROM {L}""")
def q_greater_sum(spark, d):
    return sq.greater_sum(lines(spark, d).select("l_orderkey", "l_linenumber", "q"), ["l_orderkey"], "q").select(
        "l_orderkey", "l_linenumber", F.col("greater_sum").cast("long").alias("greater_sum"))


@query("range_sum_query", f"""
WITH qy AS (SELECT o_orderkey AS l_orderkey, 1 + o_orderkey % 3 AS lo, 3 + o_orderkey % 3 AS hi FROM orders)
SELECT qy.l_orderkey, qy.lo, qy.hi, CAST(coalesce(sum(l.q), 0) AS BIGINT) AS range_sum
FROM qy LEFT JOIN {L} l ON l.l_orderkey = qy.l_orderkey AND l.l_linenumber BETWEEN qy.lo AND qy.hi
GROUP BY 1, 2, 3""")
def q_range_sum_query(spark, d):
    qs = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                          (F.col("o_orderkey") % 3 + 1).alias("lo"),
                                          (F.col("o_orderkey") % 3 + 3).alias("hi"))
    return sq.range_sum_query(lines(spark, d), qs, ["l_orderkey"], "l_linenumber", "q")


@query("timed_range_sums", """
WITH u AS (SELECT o_orderpriority AS p, o_custkey % 100 AS pos, o_orderkey AS t, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders),
dl AS (SELECT p, pos, t, v - coalesce(lag(v) OVER (PARTITION BY p, pos ORDER BY t), 0) AS dv FROM u)
SELECT q.o_orderkey, CAST(coalesce(sum(dl.dv), 0) AS BIGINT) AS range_sum
FROM orders q LEFT JOIN dl ON dl.p = q.o_orderpriority AND dl.t <= q.o_orderkey AND dl.pos BETWEEN q.o_custkey % 50 AND q.o_custkey % 50 + 20
GROUP BY 1""")
def q_timed_range_sums(spark, d):
    o = table(spark, d, "orders")
    updates = o.select("o_orderpriority", (F.col("o_custkey") % 100).alias("pos"), F.col("o_orderkey").alias("t"),
                       F.floor("o_totalprice").cast("long").alias("v"))
    asked = o.select("o_orderpriority", "o_orderkey", F.col("o_orderkey").alias("t"), (F.col("o_custkey") % 50).alias("lo"),
                     (F.col("o_custkey") % 50 + 20).alias("hi"))
    out = sq.timed_range_sums(updates, asked, ["o_orderpriority"], "pos", "v", "t")
    return out.select("o_orderkey", F.col("range_sum").cast("long").alias("range_sum"))


@query("range_update", f"""
WITH s AS {S},
dl AS (SELECT pos, sum(dv) AS dv FROM (SELECT st AS pos, 1 AS dv FROM s UNION ALL SELECT en + 1, -1 FROM s) GROUP BY pos),
spine AS (SELECT unnest(generate_series((SELECT min(st) FROM s), (SELECT max(en) FROM s))) AS pos)
SELECT spine.pos, CAST(sum(coalesce(dl.dv, 0)) OVER (ORDER BY spine.pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value
FROM spine LEFT JOIN dl ON dl.pos = spine.pos""")
def q_range_update(spark, d):
    return sq.range_update(spans(spark, d), "st", "en").select(F.col("pos").cast("long").alias("pos"),
                                                                F.col("value").cast("long").alias("value"))


@query("moving_average", f"""
SELECT user_id, event_id, avg(cents) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving_avg FROM {E}""")
def q_moving_average(spark, d):
    return sq.moving_average(events(spark, d), ["user_id"], ORDER, "cents", 3).select(
        "user_id", "event_id", "moving_avg")


@query("recent_count", f"""
SELECT user_id, event_id,
       count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {DAY_US} PRECEDING AND CURRENT ROW) AS recent
FROM {E}""")
def q_recent_count(spark, d):
    return sq.recent_count(events(spark, d), ["user_id"], "us", F.lit(DAY_US), "event_id").select(
        "user_id", "event_id", "recent")


@query("best_single_trade", f"""
SELECT user_id, greatest(max(cents - mn), 0) AS best_profit FROM (
  SELECT user_id, cents, min(cents) OVER ({W} ROWS UNBOUNDED PRECEDING) AS mn FROM {E}) GROUP BY 1""")
def q_best_single_trade(spark, d):
    return sq.best_single_trade(events(spark, d), ["user_id"], ORDER, "cents")


@query("sum_of_rises", f"""
SELECT user_id, CAST(coalesce(sum(greatest(cents - pv, 0)), 0) AS BIGINT) AS sum_rises FROM (
  SELECT user_id, cents, lag(cents) OVER ({W}) AS pv FROM {E}) GROUP BY 1""")
def q_sum_of_rises(spark, d):
    return sq.sum_of_rises(events(spark, d), ["user_id"], ORDER, "cents")


@query("best_two_trades", f"""
WITH a AS (SELECT user_id, ts, event_id, cents, cents - min(cents) OVER ({W} ROWS UNBOUNDED PRECEDING) AS gain,
                  max(cents) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING)
                    - cents AS gain2 FROM {E}),
b AS (SELECT user_id, max(gain) OVER ({W} ROWS UNBOUNDED PRECEDING) AS f,
             max(gain2) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS g
      FROM a)
SELECT user_id, greatest(max(f + g), 0) AS best_two FROM b GROUP BY 1""")
def q_best_two_trades(spark, d):
    return sq.best_two_trades(events(spark, d), ["user_id"], ORDER, "cents")


@query("max_segment_sum", f"""
WITH p AS (SELECT user_id, ts, event_id, sum(cents - 10000) OVER ({W} ROWS UNBOUNDED PRECEDING) AS p FROM {E}),
m AS (SELECT user_id, p, min(p) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM p)
SELECT user_id, CAST(max(p - least(coalesce(pm, 0), 0)) AS BIGINT) AS max_sum FROM m GROUP BY 1""")
def q_max_segment_sum(spark, d):
    e = events(spark, d).withColumn("v", F.col("cents") - 10000)
    return sq.max_segment_sum(e, ["user_id"], ORDER, "v")


def _segments_sql(val: str, k: int) -> str:
    return f"""
WITH p AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LO}) AS i,
                  sum({val}) OVER (PARTITION BY l_orderkey ORDER BY {LO} ROWS UNBOUNDED PRECEDING) AS p FROM {L}
           UNION ALL SELECT DISTINCT l_orderkey, 0, 0 FROM lineitem),
pairs AS (SELECT x.l_orderkey, count(*) AS c FROM p x JOIN p y
          ON x.l_orderkey = y.l_orderkey AND x.i < y.i AND y.p - x.p = {k} GROUP BY 1)
SELECT kk.l_orderkey, CAST(coalesce(pairs.c, 0) AS BIGINT) AS segments
FROM (SELECT DISTINCT l_orderkey FROM lineitem) kk LEFT JOIN pairs ON pairs.l_orderkey = kk.l_orderkey"""


@query("segments_with_sum", _segments_sql("q", 50))
def q_segments_with_sum(spark, d):
    return sq.segments_with_sum(lines(spark, d), ["l_orderkey"], LORDER, "q", 50)


@query("odd_count_segments", _segments_sql("q % 2", 2))
def q_odd_count_segments(spark, d):
    return sq.segments_with_sum(lines(spark, d).withColumn("odd", F.col("q") % 2), ["l_orderkey"],
                                LORDER, "odd", 2)


@query("balance_point", f"""
WITH a AS (SELECT l_orderkey, l_linenumber, q,
                  coalesce(sum(q) OVER (PARTITION BY l_orderkey ORDER BY {LO}
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
                  sum(q) OVER (PARTITION BY l_orderkey) AS tot FROM {L})
SELECT l_orderkey, CAST(coalesce(min(CASE WHEN lft = tot - lft - q THEN l_linenumber END), -1) AS BIGINT) AS pivot
FROM a GROUP BY 1""")
def q_balance_point(spark, d):
    li = lines(spark, d).withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    return sq.balance_point(li, ["l_orderkey"], LORDER, "q", "l_linenumber")


@query("leave_one_out", """
WITH v AS (SELECT l_orderkey, l_linenumber, CAST((l_linenumber + l_orderkey) % 4 AS BIGINT) AS v FROM lineitem),
g AS (SELECT l_orderkey, sum(v) AS s, sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS z,
             product(CASE WHEN v <> 0 THEN v ELSE 1 END) AS p FROM v GROUP BY 1)
SELECT v.l_orderkey, v.l_linenumber, v.v,
       CASE WHEN z = 0 THEN p / v WHEN z = 1 AND v = 0 THEN p ELSE 0.0 END AS product_others,
       CAST(s - v AS BIGINT) AS sum_others
FROM v JOIN g ON v.l_orderkey = g.l_orderkey""")
def q_leave_one_out(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", ((F.col("l_linenumber") + F.col("l_orderkey")) % 4).cast("long").alias("v"))
    return sq.leave_one_out(li, ["l_orderkey"], "v")


@query("runs", f"""
SELECT user_id, event_type, min(rk) AS start_pos, max(rk) AS end_pos, count(*) AS length FROM (
  SELECT user_id, event_type, row_number() OVER ({W}) AS rk,
         row_number() OVER ({W}) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g
  FROM {E}) GROUP BY user_id, event_type, g""")
def q_runs(spark, d):
    return sq.runs(events(spark, d).select("user_id", "event_id", "ts", "event_type"), ["user_id"], ORDER,
                   "event_type")


@query("longest_click_run", f"""
WITH a AS (SELECT user_id, event_type = 'click' AS ok,
                  row_number() OVER ({W}) - sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)
                    OVER ({W} ROWS UNBOUNDED PRECEDING) AS g FROM {E}),
r AS (SELECT user_id, max(n) AS longest_run FROM (SELECT user_id, g, count(*) AS n FROM a WHERE ok GROUP BY 1, 2)
      GROUP BY 1)
SELECT u.user_id, coalesce(r.longest_run, 0) AS longest_run
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r ON r.user_id = u.user_id""")
def q_longest_click_run(spark, d):
    return sq.longest_run(events(spark, d), ["user_id"], ORDER, F.col("event_type") == "click")


@query("longest_rising", f"""
WITH p AS (SELECT user_id, ts, event_id, cents > lag(cents) OVER ({W}) AS up FROM {E}),
a AS (SELECT user_id, coalesce(up, false) AS ok,
             row_number() OVER ({W}) - sum(CASE WHEN up THEN 1 ELSE 0 END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS g
      FROM p),
r AS (SELECT user_id, max(n) AS m FROM (SELECT user_id, g, count(*) AS n FROM a WHERE ok GROUP BY 1, 2) GROUP BY 1)
SELECT u.user_id, coalesce(r.m, 0) + 1 AS longest_rising
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r ON r.user_id = u.user_id""")
def q_longest_rising(spark, d):
    return sq.longest_rising(events(spark, d), ["user_id"], ORDER, "cents")


@query("islands", f"""
WITH dd AS (SELECT DISTINCT o_custkey, day FROM {OD})
SELECT o_custkey, min(day) AS range_start, max(day) AS range_end, count(*) AS length FROM (
  SELECT o_custkey, day, day - row_number() OVER (PARTITION BY o_custkey ORDER BY day) AS g FROM dd)
GROUP BY o_custkey, g""")
def q_islands(spark, d):
    return sq.islands(order_days(spark, d), ["o_custkey"], "day")


@query("gaps", f"""
WITH dd AS (SELECT DISTINCT o_custkey, day FROM {OD}),
p AS (SELECT o_custkey, day, lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS pv FROM dd)
SELECT o_custkey, pv + 1 AS gap_start, day - 1 AS gap_end FROM p WHERE day - pv > 1""")
def q_gaps(spark, d):
    return sq.gaps(order_days(spark, d), ["o_custkey"], "day")


@query("missing_ranges", f"""
WITH dd AS (SELECT DISTINCT l_suppkey, q FROM {L} WHERE q BETWEEN 5 AND 60),
b AS (SELECT * FROM dd UNION ALL
      SELECT DISTINCT l_suppkey, unnest([4, 61]) AS q FROM lineitem),
p AS (SELECT l_suppkey, q, lag(q) OVER (PARTITION BY l_suppkey ORDER BY q) AS pv FROM b)
SELECT l_suppkey, pv + 1 AS gap_start, q - 1 AS gap_end FROM p WHERE q - pv > 1""")
def q_missing_ranges(spark, d):
    return sq.gaps(lines(spark, d), ["l_suppkey"], "q", F.lit(5), F.lit(60))


@query("first_missing_positive", f"""
WITH dd AS (SELECT DISTINCT l_suppkey, q FROM {L} WHERE q > 0),
r AS (SELECT l_suppkey, q, row_number() OVER (PARTITION BY l_suppkey ORDER BY q) AS r FROM dd)
SELECT l_suppkey, coalesce(min(CASE WHEN q <> r THEN r END), count(*) + 1) AS first_missing FROM r GROUP BY 1""")
def q_first_missing_positive(spark, d):
    return sq.first_missing_positive(lines(spark, d), ["l_suppkey"], "q")


@query("kth_missing_positive", f"""
WITH dd AS (SELECT DISTINCT l_suppkey, q FROM {L} WHERE q > 0),
r AS (SELECT l_suppkey, q, row_number() OVER (PARTITION BY l_suppkey ORDER BY q) AS r FROM dd)
SELECT l_suppkey, CAST(5 + sum(CASE WHEN q - r < 5 THEN 1 ELSE 0 END) AS BIGINT) AS kth_missing FROM r GROUP BY 1""")
def q_kth_missing_positive(spark, d):
    return sq.kth_missing_positive(lines(spark, d), ["l_suppkey"], "q", 5)


@query("multiple_segments", f"""
WITH p AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LO}) AS i,
                  sum(q) OVER (PARTITION BY l_orderkey ORDER BY {LO} ROWS UNBOUNDED PRECEDING) AS p FROM {L}
           UNION ALL SELECT DISTINCT l_orderkey, 0, 0 FROM lineitem),
g AS (SELECT l_orderkey, ((p % 7) + 7) % 7 AS res, max(i) - min(i) AS w FROM p GROUP BY 1, 2)
SELECT l_orderkey, max(w) >= 2 AS has_multiple FROM g GROUP BY 1""")
def q_multiple_segments(spark, d):
    return sq.has_multiple_segment(lines(spark, d), ["l_orderkey"], LORDER, "q", 7)


@query("max_gap", f"""
SELECT user_id, max(us - pv) AS max_gap FROM (
  SELECT user_id, us, lag(us) OVER (PARTITION BY user_id ORDER BY us) AS pv FROM {E}) GROUP BY 1""")
def q_max_gap(spark, d):
    return sq.max_gap(events(spark, d), ["user_id"], "us")


@query("local_peaks", f"""
SELECT user_id, event_id FROM (
  SELECT user_id, event_id, cents, lag(cents) OVER ({W}) AS pv, lead(cents) OVER ({W}) AS nx FROM {E})
WHERE (pv IS NULL OR cents > pv) AND (nx IS NULL OR cents > nx)""")
def q_local_peaks(spark, d):
    return sq.local_peaks(events(spark, d), ["user_id"], ORDER, "cents").select("user_id", "event_id")


@query("turning_points", f"""
WITH a AS (SELECT user_id, event_id, ts, cents, row_number() OVER ({W}) AS rn,
                  lag(cents) OVER ({W}) AS pv, lead(cents) OVER ({W}) AS nx FROM {E}),
b AS (SELECT *, max(CASE WHEN pv IS NULL OR cents > pv THEN rn END)
                  OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lb,
             min(CASE WHEN nx IS NULL OR cents > nx THEN rn END)
                  OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rb FROM a)
SELECT user_id, event_id FROM b WHERE rn - lb >= 2 AND rb - rn >= 2""")
def q_turning_points(spark, d):
    return sq.turning_points(events(spark, d), ["user_id"], ORDER, "cents", 2).select("user_id", "event_id")


@query("shortest_unsorted_window", f"""
WITH a AS (SELECT user_id, cents, row_number() OVER ({W}) AS rn,
                  max(cents) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pmax,
                  min(cents) OVER ({W} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS smin FROM {E})
SELECT user_id, coalesce(max(CASE WHEN cents < pmax THEN rn END) - min(CASE WHEN cents > smin THEN rn END) + 1, 0)
       AS unsorted_len FROM a GROUP BY 1""")
def q_shortest_unsorted_window(spark, d):
    return sq.shortest_unsorted_window(events(spark, d), ["user_id"], ORDER, "cents")


@query("one_change_nondecreasing", f"""
WITH a AS (SELECT l_orderkey, q, lag(q) OVER w AS p1, lag(q, 2) OVER w AS p2, lead(q) OVER w AS n1 FROM {L}
           WINDOW w AS (PARTITION BY l_orderkey ORDER BY {LO}))
SELECT l_orderkey, sum(CASE WHEN p1 IS NOT NULL AND q < p1 THEN 1 ELSE 0 END) = 0
   OR (sum(CASE WHEN p1 IS NOT NULL AND q < p1 THEN 1 ELSE 0 END) = 1
       AND max(CASE WHEN p1 IS NOT NULL AND q < p1 THEN
             CAST(p2 IS NULL OR q >= p2 OR n1 IS NULL OR n1 >= p1 AS INTEGER) END) = 1) AS fixable
FROM a GROUP BY 1""")
def q_one_change_nondecreasing(spark, d):
    return sq.one_change_nondecreasing(lines(spark, d), ["l_orderkey"], LORDER, "q")


@query("remove_one_increasing", f"""
WITH a AS (SELECT l_orderkey, q, lag(q) OVER w AS p1, lag(q, 2) OVER w AS p2, lead(q) OVER w AS n1 FROM {L}
           WINDOW w AS (PARTITION BY l_orderkey ORDER BY {LO}))
SELECT l_orderkey, sum(CASE WHEN p1 IS NOT NULL AND q <= p1 THEN 1 ELSE 0 END) = 0
   OR (sum(CASE WHEN p1 IS NOT NULL AND q <= p1 THEN 1 ELSE 0 END) = 1
       AND max(CASE WHEN p1 IS NOT NULL AND q <= p1 THEN
             CAST(p2 IS NULL OR q > p2 OR n1 IS NULL OR n1 > p1 AS INTEGER) END) = 1) AS removable
FROM a GROUP BY 1""")
def q_remove_one_increasing(spark, d):
    return sq.remove_one_increasing(lines(spark, d), ["l_orderkey"], LORDER, "q")


@query("longest_no_loss_span", f"""
WITH a AS (SELECT user_id, cents, row_number() OVER ({W}) AS pos FROM {E}),
b AS (SELECT user_id, pos - min(pos) OVER (PARTITION BY user_id ORDER BY cents, pos ROWS UNBOUNDED PRECEDING) AS sp
      FROM a)
SELECT user_id, max(sp) AS span FROM b GROUP BY 1""")
def q_longest_no_loss_span(spark, d):
    return sq.longest_no_loss_span(events(spark, d), ["user_id"], ORDER, "cents")


@query("dip_area", f"""
WITH a AS (SELECT user_id, CAST(floor(cents / 5000) AS BIGINT) AS v, ts, event_id FROM {E}),
b AS (SELECT user_id, v, max(v) OVER ({W} ROWS UNBOUNDED PRECEDING) AS lm,
             max(v) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC ROWS UNBOUNDED PRECEDING) AS rm FROM a)
SELECT user_id, CAST(sum(least(lm, rm) - v) AS BIGINT) AS area FROM b GROUP BY 1""")
def q_dip_area(spark, d):
    e = events(spark, d).withColumn("v", F.floor(F.col("cents") / 5000).cast("long"))
    return sq.dip_area(e, ["user_id"], ORDER, "v")


@query("last_repeat_window", f"""
WITH a AS (SELECT user_id, event_type, ts, event_id, row_number() OVER ({W}) AS pos FROM {E}),
b AS (SELECT *, lag(pos) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM a),
c AS (SELECT user_id, pos, max(coalesce(prev, 0) + 1) OVER ({W} ROWS UNBOUNDED PRECEDING) AS st FROM b)
SELECT user_id, max(pos - st + 1) AS longest_distinct FROM c GROUP BY 1""")
def q_last_repeat_window(spark, d):
    return sq.last_repeat_window(events(spark, d), ["user_id"], ORDER, "event_type")


@query("k_distinct_window", f"""
WITH a AS (SELECT user_id, event_type, row_number() OVER ({W}) AS pos FROM {E}),
l AS (SELECT x.user_id, x.pos, max(y.pos) AS last FROM a x JOIN a y ON x.user_id = y.user_id AND y.pos <= x.pos GROUP BY x.user_id, x.pos, y.event_type),
n AS (SELECT user_id, pos, coalesce(list_sort(list(last), 'DESC')[3], 0) AS before FROM l GROUP BY user_id, pos)
SELECT user_id, max(pos - before) AS longest_k_distinct FROM n GROUP BY 1""")
def q_k_distinct_window(spark, d):
    return sq.k_distinct_window(events(spark, d), ["user_id"], ORDER, "event_type", 2)


@query("bag_match_windows", f"""
WITH a AS (SELECT user_id, row_number() OVER ({W}) AS pos,
                  sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS c0,
                  sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS c1,
                  sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER ({W} ROWS UNBOUNDED PRECEDING) AS c2
           FROM {E})
SELECT x.user_id, x.pos - 2 AS start_pos FROM a x LEFT JOIN a y ON y.user_id = x.user_id AND y.pos = x.pos - 3
WHERE x.pos >= 3 AND x.c0 - coalesce(y.c0, 0) = 1 AND x.c1 - coalesce(y.c1, 0) = 1
  AND x.c2 - coalesce(y.c2, 0) = 1""")
def q_bag_match_windows(spark, d):
    return sq.bag_match_windows(events(spark, d), ["user_id"], ORDER, "event_type",
                                {"view": 1, "click": 1, "purchase": 1})


@query("min_cover_window", f"""
WITH a AS (SELECT user_id, event_type, ts, event_id, row_number() OVER ({W}) AS pos FROM {E}),
v AS (SELECT user_id, pos, last(CASE WHEN event_type = 'view' THEN pos END IGNORE NULLS)
        OVER ({W} ROWS UNBOUNDED PRECEDING) AS pv FROM a),
c AS (SELECT user_id, pos, lag(pos) OVER (PARTITION BY user_id ORDER BY pos) AS c2 FROM a WHERE event_type = 'click'),
cc AS (SELECT a.user_id, a.pos, last(c.c2 IGNORE NULLS) OVER (PARTITION BY a.user_id ORDER BY a.pos
        ROWS UNBOUNDED PRECEDING) AS pc FROM a LEFT JOIN c ON c.user_id = a.user_id AND c.pos = a.pos),
w AS (SELECT v.user_id, least(pv, pc) AS s, v.pos AS e FROM v JOIN cc ON cc.user_id = v.user_id AND cc.pos = v.pos
      WHERE pv IS NOT NULL AND pc IS NOT NULL)
SELECT user_id, min_len AS min_window, s AS win_start, e AS win_end FROM (
  SELECT user_id, e - s + 1 AS min_len, s, e,
         row_number() OVER (PARTITION BY user_id ORDER BY e - s + 1, s, e) AS r FROM w) WHERE r = 1""")
def q_min_cover_window(spark, d):
    return sq.min_cover_window(events(spark, d), ["user_id"], ORDER, "event_type", {"view": 1, "click": 2})


@query("min_item_distance", f"""
WITH a AS (SELECT user_id, event_type, ts, event_id, row_number() OVER ({W}) AS pos FROM {E}),
b AS (SELECT *, last(CASE WHEN event_type = 'view' THEN pos END IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS la,
             last(CASE WHEN event_type = 'purchase' THEN pos END IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) AS lb
      FROM a)
SELECT user_id, min(CASE WHEN event_type = 'view' THEN pos - lb WHEN event_type = 'purchase' THEN pos - la END)
       AS min_distance FROM b GROUP BY 1
HAVING min(CASE WHEN event_type = 'view' THEN pos - lb WHEN event_type = 'purchase' THEN pos - la END) IS NOT NULL""")
def q_min_item_distance(spark, d):
    return sq.min_item_distance(events(spark, d), ["user_id"], ORDER, "event_type", "view", "purchase")


@query("ordered_funnel", """
WITH s1 AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'view' GROUP BY 1),
s2 AS (SELECT e.user_id, min(e.ts) AS t FROM events e JOIN s1 ON e.user_id = s1.user_id
       WHERE e.event_type = 'click' AND e.ts > s1.t GROUP BY 1),
s3 AS (SELECT e.user_id, min(e.ts) AS t FROM events e JOIN s2 ON e.user_id = s2.user_id
       WHERE e.event_type = 'purchase' AND e.ts > s2.t GROUP BY 1)
SELECT u.user_id, (s1.t IS NOT NULL)::INTEGER + (s2.t IS NOT NULL)::INTEGER + (s3.t IS NOT NULL)::INTEGER AS steps_done,
       s3.t IS NOT NULL AS complete
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN s1 ON s1.user_id = u.user_id
  LEFT JOIN s2 ON s2.user_id = u.user_id LEFT JOIN s3 ON s3.user_id = u.user_id""")
def q_ordered_funnel(spark, d):
    return sq.ordered_funnel(table(spark, d, "events"), ["user_id"], "ts", "event_type", ["view", "click", "purchase"])


@query("assign_unique_slots", f"""
WITH a AS (SELECT o_custkey, o_orderkey, day, row_number() OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey) AS r
           FROM {OD})
SELECT o_custkey, o_orderkey, day,
       max(day - r) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS UNBOUNDED PRECEDING) + r AS slot FROM a""")
def q_assign_unique_slots(spark, d):
    return sq.assign_unique_slots(order_days(spark, d), ["o_custkey"], "day", "o_orderkey")


@query("merge_intervals", f"""
WITH a AS (SELECT o_custkey, st, en, max(en) OVER (PARTITION BY o_custkey ORDER BY st, en
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS me FROM {S}),
b AS (SELECT *, sum(CASE WHEN me IS NULL OR st > me THEN 1 ELSE 0 END)
             OVER (PARTITION BY o_custkey ORDER BY st, en ROWS UNBOUNDED PRECEDING) AS isl FROM a)
SELECT o_custkey, min(st) AS st, max(en) AS en FROM b GROUP BY o_custkey, isl""")
def q_merge_intervals(spark, d):
    return sq.merge_intervals(spans(spark, d), ["o_custkey"], "st", "en")


@query("interval_conflicts", f"""
WITH s AS {S},
a AS (SELECT o_custkey, coalesce(st < max(en) OVER (PARTITION BY o_custkey ORDER BY st, en
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS c FROM s),
ev AS (SELECT o_custkey, t, sum(dv) AS net FROM (SELECT o_custkey, st AS t, 1 AS dv FROM s
       UNION ALL SELECT o_custkey, en, -1 FROM s) GROUP BY 1, 2),
pk AS (SELECT o_custkey, max(run) AS max_concurrent FROM (
        SELECT o_custkey, sum(net) OVER (PARTITION BY o_custkey ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM ev)
       GROUP BY 1)
SELECT a.o_custkey, bool_or(c) AS has_conflict, CAST(any_value(pk.max_concurrent) AS BIGINT) AS max_concurrent
FROM a JOIN pk ON pk.o_custkey = a.o_custkey GROUP BY a.o_custkey""")
def q_interval_conflicts(spark, d):
    r = sq.interval_conflicts(spans(spark, d), ["o_custkey"], "st", "en")
    return r.withColumn("max_concurrent", F.col("max_concurrent").cast("long"))
