"""Sorts, limits, top-k and set operators bound to the driver tables (survey 2.6, 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sorts as so
from ..sources.tables import table
from .registry import query
from .sequences import E, events


@query("k_nearest", """
WITH q AS (SELECT embedding AS qv FROM embeddings ORDER BY vec_id LIMIT 1),
d AS (SELECT vec_id, list_reduce(list_transform(range(1, len(embedding) + 1),
                                 lambda i: pow(CAST(embedding[i] AS DOUBLE) - CAST(qv[i] AS DOUBLE), 2)),
                                 lambda a, b: a + b) AS dist2 FROM embeddings, q)
SELECT vec_id, row_number() OVER (ORDER BY dist2, vec_id) AS rank FROM d ORDER BY dist2, vec_id LIMIT 10""")
def q_k_nearest(spark, d):
    e = table(spark, d, "embeddings")
    q = e.orderBy("vec_id").limit(1).select(F.col("embedding").alias("qv"))
    return so.k_nearest(e, "vec_id", "embedding", q, "qv", 10)


@query("k_nearest_origin", """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS x, CAST(floor(c_acctbal / 100) AS BIGINT) AS y,
       CAST(c_nationkey AS BIGINT) * c_nationkey + CAST(floor(c_acctbal / 100) AS BIGINT) * floor(c_acctbal / 100)
         AS dist2
FROM customer ORDER BY dist2, c_custkey LIMIT 10""")
def q_k_nearest_origin(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("x"),
                                           F.floor(F.col("c_acctbal") / 100).cast("long").alias("y"))
    r = so.k_nearest_xy(c, "c_custkey", "x", "y", 10)
    return r.withColumn("dist2", F.col("dist2").cast("double"))


@query("stable_partition", f"""
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'error' THEN 1
                                             ELSE 0 END, ts, event_id) AS new_pos FROM {E}""")
def q_stable_partition(spark, d):
    e = events(spark, d).select("user_id", "event_id", "ts", "event_type")
    return so.stable_partition(e, ["user_id"], ["ts", "event_id"], F.col("event_type") != "error").select(
        "user_id", "event_id", "new_pos")


@query("compound_sort", """
WITH l AS (SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS log_id, text,
                  CASE WHEN regexp_matches(substr(text, 1, 1), '^[0-9]') THEN 1 ELSE 0 END AS dig
           FROM conversations)
SELECT conv_id, turn, row_number() OVER (ORDER BY dig, CASE WHEN dig = 0 THEN text END NULLS FIRST,
                                         CASE WHEN dig = 0 THEN log_id END NULLS FIRST, conv_id * 2147483648 + turn) AS sort_pos
FROM l""")
def q_compound_sort(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    log_id = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    r = so.compound_sort(c, log_id, F.col("text"), F.col("conv_id") * 2147483648 + F.col("turn"))
    return r.select("conv_id", "turn", "sort_pos")


@query("order_by_transform", """
SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal * c_acctbal, c_custkey) AS pos FROM customer""")
def q_order_by_transform(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return so.order_by_transform(c, F.col("c_acctbal") * F.col("c_acctbal"), "c_custkey").select("c_custkey", "pos")


@query("keep_first_n", """
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents)
WHERE r <= 1""")
def q_keep_first_n(spark, d):
    return so.keep_first_n(table(spark, d, "documents").select("doc_id", "text"), ["text"], ["doc_id"], 1).select("doc_id")


@query("keep_first_two", """
SELECT user_id, event_id FROM (SELECT user_id, event_id,
       row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r <= 2""")
def q_keep_first_two(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return so.keep_first_n(e, ["user_id", "event_type"], ["ts", "event_id"], 2).select("user_id", "event_id")


@query("rank_smaller", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice) - 1 AS BIGINT) AS n_smaller
FROM lineitem""")
def q_rank_smaller(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return so.rank_smaller(li, ["l_orderkey"], "l_extendedprice").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_smaller")


@query("weakest_groups", """
SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS ones FROM orders
GROUP BY 1 ORDER BY ones, o_custkey LIMIT 10""")
def q_weakest_groups(spark, d):
    r = so.weakest_groups(table(spark, d, "orders"), "o_custkey", F.col("o_orderstatus") == "F", 10)
    return r.withColumn("ones", F.col("ones").cast("long"))


@query("shuffle_sample", """
SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey LIMIT 20""")
def q_shuffle_sample(spark, d):
    return so.shuffle_sample(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 42, 20)


@query("intersect_distinct", """
SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier""")
def q_intersect_distinct(spark, d):
    return so.intersect_distinct(table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")),
                                 table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")))


@query("intersect_bag", """
SELECT c_nationkey AS nation FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier""")
def q_intersect_bag(spark, d):
    return so.intersect_bag(table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")),
                            table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")))


@query("merge_sorted", """
SELECT k, row_number() OVER (ORDER BY k) AS pos FROM (
  SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer)""")
def q_merge_sorted(spark, d):
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return so.merge_sorted([a, b], "k")
