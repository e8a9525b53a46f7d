"""Join operators bound to the driver tables (survey 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import joins as jn
from ..sources.tables import table
from .aggregations import BANNED, HOST
from .registry import query
from .sequences import E, events, spans

_WORDS = r"""(SELECT doc_id, word FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word
              FROM documents) WHERE length(word) > 0)"""


def _doc_words(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(tx.words("text")).alias("word"))


@query("complement_pairs", """
WITH c AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS v, count(*) AS n FROM lineitem GROUP BY 1, 2),
p AS (SELECT a.l_orderkey, a.v AS v_lo, b.v AS v_hi,
             CAST(CASE WHEN a.v = b.v THEN a.n * (a.n - 1) / 2 ELSE a.n * b.n END AS BIGINT) AS n_pairs
      FROM c a JOIN c b ON a.l_orderkey = b.l_orderkey AND b.v = 50 - a.v AND a.v <= b.v)
SELECT * FROM p WHERE n_pairs > 0""")
def q_complement_pairs(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("v"))
    return jn.complement_pairs(li, ["l_orderkey"], "v", 50)


@query("first_complement_pair", """
WITH e AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) AS v FROM events),
p AS (SELECT a.user_id, a.event_id AS first_id, b.event_id AS second_id,
             row_number() OVER (PARTITION BY a.user_id ORDER BY a.event_id, b.event_id) AS r
      FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_id < b.event_id AND a.v + b.v = 300)
SELECT user_id, first_id, second_id FROM p WHERE r = 1""")
def q_first_complement_pair(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.floor("value").cast("long").alias("v"))
    return jn.first_complement_pair(e, ["user_id"], "v", "event_id", 300)


@query("k_sum_groups", """
WITH c AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS v, count(*) AS n FROM lineitem GROUP BY 1, 2),
t AS (SELECT a.l_orderkey, a.v AS v1, b.v AS v2, c3.v AS v3, a.n AS n1, b.n AS n2, c3.n AS n3
      FROM c a JOIN c b ON a.l_orderkey = b.l_orderkey AND b.v >= a.v
      JOIN c c3 ON c3.l_orderkey = a.l_orderkey AND c3.v = 60 - a.v - b.v WHERE c3.v >= b.v),
r AS (SELECT l_orderkey, v1, v2, v3, CAST(CASE WHEN v1 = v2 AND v2 = v3 THEN n1 * (n1 - 1) * (n1 - 2) / 6
                                              WHEN v1 = v2 THEN n1 * (n1 - 1) / 2 * n3
                                              WHEN v2 = v3 THEN n2 * (n2 - 1) / 2 * n1
                                              ELSE n1 * n2 * n3 END AS BIGINT) % 1000000007 AS n_triples FROM t)
SELECT * FROM r WHERE n_triples > 0""")
def q_k_sum_groups(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("v"))
    return jn.k_sum_groups(li, ["l_orderkey"], "v", 60)


def _multiset_sql(k: int) -> str:
    """SQL twin of joins.multiset_count for columns v1..vk, n1..nk."""
    from ..operators.joins import _runs_patterns
    parts = []
    for mask, runs in _runs_patterns(k):
        cond = " AND ".join(f"v{i + 1} {'=' if mask >> i & 1 else '<'} v{i + 2}" for i in range(k - 1))
        terms, pos = [], 1
        for r in runs:
            num = " * ".join(f"(n{pos} - {j})" for j in range(r)) if r > 1 else f"n{pos}"
            fact = 1
            for j in range(2, r + 1):
                fact *= j
            terms.append(f"({num}) / {fact}" if r > 1 else num)
            pos += r
        parts.append(f"WHEN {cond} THEN {' * '.join(terms)}")
    return "CASE " + " ".join(parts) + " END"


@query("four_sum_groups", f"""
WITH c AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS v, count(*) AS n FROM lineitem GROUP BY 1, 2),
q AS (SELECT a.l_orderkey, a.v AS v1, b.v AS v2, x.v AS v3, y.v AS v4, a.n AS n1, b.n AS n2, x.n AS n3, y.n AS n4
      FROM c a JOIN c b ON b.l_orderkey = a.l_orderkey AND b.v >= a.v
      JOIN c x ON x.l_orderkey = a.l_orderkey AND x.v >= b.v
      JOIN c y ON y.l_orderkey = a.l_orderkey AND y.v >= x.v AND a.v + b.v + x.v + y.v = 100),
r AS (SELECT l_orderkey, v1, v2, v3, v4, CAST({_multiset_sql(4)} AS BIGINT) % 1000000007 AS n_quads FROM q)
SELECT * FROM r WHERE n_quads > 0""")
def q_four_sum_groups(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("v"))
    return jn.k_sum_groups(li, ["l_orderkey"], "v", 100, k=4)


@query("last_index_lookup", """
SELECT p.p_partkey AS l_partkey, m.last_pos FROM part p
LEFT JOIN (SELECT l_partkey, max(l_orderkey) AS last_pos FROM lineitem GROUP BY 1) m ON m.l_partkey = p.p_partkey""")
def q_last_index_lookup(spark, d):
    a = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"))
    return jn.last_index_lookup(a, table(spark, d, "lineitem"), "l_partkey", "l_orderkey")


@query("asof_join", f"""
WITH p AS (SELECT user_id, event_id, ts FROM {E} WHERE event_type = 'purchase'),
v AS (SELECT user_id, ts AS v_ts, event_id AS view_id, cents AS view_cents FROM {E} WHERE event_type = 'view')
SELECT p.user_id, p.event_id, v.view_id AS r_view_id, v.view_cents AS r_view_cents
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.v_ts""")
def q_asof_join(spark, d):
    e = events(spark, d)
    p = e.where(F.col("event_type") == "purchase").select("user_id", "event_id", "ts")
    v = e.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("v_ts"),
                                                      F.col("event_id").alias("view_id"),
                                                      F.col("cents").alias("view_cents"))
    return jn.asof_join(p, v, ["user_id"], "ts", "v_ts", ["view_id", "view_cents"]).select(
        "user_id", "event_id", "r_view_id", "r_view_cents")


_NEAREST_SQL = """
WITH c AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer),
s AS (SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier),
r AS (SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, s.s_suppkey, abs(c.c_acctbal - s.s_acctbal) AS distance,
             row_number() OVER (PARTITION BY c.c_custkey
                                ORDER BY abs(c.c_acctbal - s.s_acctbal), s.s_acctbal, s.s_suppkey DESC) AS rk
      FROM c LEFT JOIN s ON s.s_nationkey = c.c_nationkey)"""


def _nearest(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("c_nationkey"), "s_acctbal")
    return jn.nearest_join(c, s, ["c_nationkey"], "c_acctbal", "s_acctbal", "s_suppkey")


@query("nearest_join", _NEAREST_SQL + """
SELECT c_custkey, c_nationkey, c_acctbal, s_suppkey, distance FROM r WHERE rk = 1""")
def q_nearest_join(spark, d):
    return _nearest(spark, d)


@query("covering_radius", _NEAREST_SQL + """
SELECT c_nationkey, max(distance) AS radius FROM r WHERE rk = 1 GROUP BY 1""")
def q_covering_radius(spark, d):
    return jn.covering_radius(_nearest(spark, d), ["c_nationkey"])


_ORDER_SPANS = """(SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS st,
       CAST(CAST(max(l_shipdate) AS DATE) - DATE '1970-01-01' AS BIGINT) AS en
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey, o_orderdate)"""


@query("interval_overlap_join", f"""
WITH o AS {_ORDER_SPANS}
SELECT a.o_custkey, a.o_orderkey, b.o_orderkey AS other_key, least(a.en, b.en) - greatest(a.st, b.st) + 1 AS overlap
FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND greatest(a.st, b.st) <= least(a.en, b.en)""")
def q_interval_overlap_join(spark, d):
    """Orders of a customer open at the same time (each also with itself): the
    pairs grow with the customers, not with the square of a span's partners."""
    o = spans(spark, d).select("o_custkey", "o_orderkey", "st", "en")
    return jn.interval_overlap_join(o, o.withColumnRenamed("o_orderkey", "other_key"), ["o_custkey"], "o_orderkey", "other_key",
                                    width=64)


@query("campaign_overlap", f"""
WITH o AS {_ORDER_SPANS},
c AS (SELECT CAST(n_nationkey AS BIGINT) AS campaign, 9131 + 97 * CAST(n_nationkey AS BIGINT) AS st,
             9131 + 97 * CAST(n_nationkey AS BIGINT) + 3 * (1 + CAST(n_nationkey AS BIGINT)) AS en FROM nation)
SELECT o.o_custkey, c.campaign, CAST(count(*) AS BIGINT) AS orders,
       CAST(sum(least(o.en, c.en) - greatest(o.st, c.st) + 1) AS BIGINT) AS days
FROM o JOIN c ON greatest(o.st, c.st) <= least(o.en, c.en) GROUP BY 1, 2""")
def q_campaign_overlap(spark, d):
    """Days that a customer's open orders share with fixed campaigns: one per
    nation, from 1995 on, of 3 to 75 days."""
    n = F.col("n_nationkey").cast("long")
    c = table(spark, d, "nation").select(n.alias("campaign"), (n * 97 + 9131).alias("st"))
    c = c.withColumn("en", F.col("st") + (F.col("campaign") + 1) * 3)
    o = spans(spark, d).select("o_orderkey", "st", "en", F.struct("o_custkey", "o_orderkey").alias("ord"))
    days = jn.interval_overlap_join(o, c, [], "ord", "campaign")
    return days.groupBy(F.col("ord.o_custkey").alias("o_custkey"), "campaign").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("overlap").cast("long").alias("days"))


@query("box_overlap_join", """
WITH b AS (SELECT p_partkey, 3 * p_partkey AS x1, 3 * p_partkey + CAST(p_size AS BIGINT) AS x2,
                  CAST(floor(p_retailprice / 10) AS BIGINT) AS y1, CAST(floor(p_retailprice / 10) AS BIGINT) + 9 AS y2
           FROM part)
SELECT a.p_partkey AS p_partkey_a, c.p_partkey AS p_partkey_b,
       (least(a.x2, c.x2) - greatest(a.x1, c.x1)) * (least(a.y2, c.y2) - greatest(a.y1, c.y1)) AS overlap_area,
       (a.x2 - a.x1) * (a.y2 - a.y1) + (c.x2 - c.x1) * (c.y2 - c.y1)
         - (least(a.x2, c.x2) - greatest(a.x1, c.x1)) * (least(a.y2, c.y2) - greatest(a.y1, c.y1)) AS union_area
FROM b a JOIN b c ON a.p_partkey < c.p_partkey
WHERE greatest(a.x1, c.x1) < least(a.x2, c.x2) AND greatest(a.y1, c.y1) < least(a.y2, c.y2)""")
def q_box_overlap_join(spark, d):
    """Boxes along the part number, so the plane grows with the table and a
    box meets a bounded number of others."""
    x1 = F.col("p_partkey") * 3
    p = table(spark, d, "part").select("p_partkey", x1.alias("x1"), (x1 + F.col("p_size")).cast("long").alias("x2"),
                                       F.floor(F.col("p_retailprice") / 10).cast("long").alias("y1"))
    return jn.box_overlap_join(p.withColumn("y2", F.col("y1") + 9), "p_partkey", "x1", "y1", "x2", "y2", cell=16)


@query("bag_overlap_join", r"""
WITH w AS (SELECT conv_id, role, word FROM (SELECT conv_id, role,
             unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM conversations) WHERE length(word) > 0),
a AS (SELECT conv_id, word, count(*) AS ca FROM w WHERE role = 'user' GROUP BY 1, 2),
b AS (SELECT conv_id, word, count(*) AS cb FROM w WHERE role = 'assistant' GROUP BY 1, 2),
j AS (SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.word, b.word) AS word,
             coalesce(ca, 0) AS ca, coalesce(cb, 0) AS cb
      FROM a FULL OUTER JOIN b ON a.conv_id = b.conv_id AND a.word = b.word),
g AS (SELECT conv_id, sum(least(ca, cb)) AS overlap, sum(ca) AS a_size, sum(cb) AS b_size,
             bool_and(ca <= cb) AS contained, bool_and(ca = cb) AS equal,
             min(CASE WHEN ca > 0 THEN CAST(floor(cb / ca) AS BIGINT) END) AS fits,
             min(CASE WHEN cb - ca = 1 THEN word END) AS ex, sum(CASE WHEN cb <> ca THEN 1 ELSE 0 END) AS nd
      FROM j GROUP BY conv_id)
SELECT conv_id, CAST(overlap AS BIGINT) AS overlap, CAST(a_size AS BIGINT) AS a_size, CAST(b_size AS BIGINT) AS b_size,
       contained, equal, fits, CASE WHEN b_size - a_size = 1 AND nd = 1 THEN ex END AS extra_item FROM g""")
def q_bag_overlap_join(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "role", F.explode(tx.words("text")).alias("word"))
    return jn.bag_overlap_join(c.where(F.col("role") == "user"), c.where(F.col("role") == "assistant"),
                               "conv_id", "word")


@query("bulls_and_cows", """
WITH p AS (SELECT o_orderkey, lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS secret,
                  lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') AS guess FROM orders),
s AS (SELECT *, list_sum(list_transform(range(1, 5), lambda i: (secret[i] = guess[i])::INTEGER)) AS bulls,
             list_sum(list_transform(range(0, 10), lambda dd: least(
                 length(secret) - length(replace(secret, CAST(dd AS VARCHAR), '')),
                 length(guess) - length(replace(guess, CAST(dd AS VARCHAR), ''))))) AS common FROM p)
SELECT o_orderkey, secret, guess, CAST(bulls AS BIGINT) AS bulls, CAST(common - bulls AS BIGINT) AS cows,
       CAST(bulls AS VARCHAR) || 'A' || CAST(common - bulls AS VARCHAR) || 'B' AS hint FROM s""")
def q_bulls_and_cows(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0").alias("secret"),
        F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0").alias("guess"))
    r = jn.bulls_and_cows(o, "o_orderkey", "secret", "guess")
    return r.withColumn("bulls", F.col("bulls").cast("long")).withColumn("cows", F.col("cows").cast("long"))


@query("member_count_join", """
SELECT count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 40)""")
def q_member_count_join(spark, d):
    members = table(spark, d, "part").where(F.col("p_size") > 40)
    return jn.member_count_join(table(spark, d, "lineitem"), "l_partkey", members, "p_partkey")


@query("stopword_anti_join", f"""
SELECT doc_id, count(*) AS n_tokens FROM {_WORDS}
WHERE word NOT IN ({", ".join(f"'{w}'" for w in BANNED)}) GROUP BY doc_id""")
def q_stopword_anti_join(spark, d):
    t = jn.stopword_anti_join(_doc_words(spark, d), "word", BANNED)
    return t.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


@query("edit_distance_hosts", f"""
WITH h AS (SELECT DISTINCT regexp_extract(url, '{HOST}', 1) AS w FROM pages)
SELECT a.w AS w1, b.w AS w2, levenshtein(a.w, b.w) AS distance FROM h a JOIN h b ON a.w < b.w
WHERE levenshtein(a.w, b.w) <= 2""")
def q_edit_distance_hosts(spark, d):
    h = table(spark, d, "pages").select(F.regexp_extract("url", HOST, 1).alias("host"))
    return jn.edit_distance_join(h, "host", 2)


@query("edit_distance_words", r"""
WITH w AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS w FROM documents) WHERE w <> ''),
pos AS (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM w),
cut AS (SELECT w, i, substr(w, 1, i - 1) || substr(w, i + 1) AS k FROM pos),
pairs AS (SELECT a.w AS w1, b.w AS w2 FROM cut a JOIN cut b ON a.k = b.k AND a.i = b.i AND a.w < b.w
          UNION SELECT least(w.w, cut.w), greatest(w.w, cut.w) FROM w JOIN cut ON cut.k = w.w)
SELECT w1, w2, CAST(1 AS BIGINT) AS distance FROM pairs""")
def q_edit_distance_words(spark, d):
    """One-edit pairs among all distinct words of the documents."""
    return jn.edit_distance_join(_doc_words(spark, d), "word", 1)


_CODE_SQL = """(SELECT vec_id, embedding AS e FROM embeddings)"""


@query("hamming_join", f"""
WITH c AS {_CODE_SQL}
SELECT * FROM (SELECT a.vec_id AS vec_id_a, b.vec_id AS vec_id_b,
       CAST(list_sum(list_transform(range(1, 65), lambda i: ((a.e[i] > 0) != (b.e[i] > 0))::INTEGER)) AS BIGINT)
         AS distance FROM c a JOIN c b ON a.vec_id < b.vec_id) WHERE distance <= 20""")
def q_hamming_join(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", jn.sign_code(F.col("embedding")).alias("code"))
    return jn.hamming_join(e, "vec_id", "code", 20)


@query("prefix_lookup", f"""
WITH p AS (SELECT DISTINCT event_type FROM events)
SELECT p.event_type, count(w.word) AS n_prefixed, CAST(coalesce(sum(CASE WHEN w.word = p.event_type THEN 1 END), 0)
       AS BIGINT) AS n_exact
FROM p LEFT JOIN {_WORDS} w ON starts_with(w.word, p.event_type) GROUP BY p.event_type""")
def q_prefix_lookup(spark, d):
    probes = table(spark, d, "events").select("event_type")
    return jn.prefix_lookup(_doc_words(spark, d), "word", probes, "event_type")


@query("k_smallest_pairs", """
SELECT p_partkey, s_suppkey, p_retailprice + s_acctbal AS total FROM part, supplier
ORDER BY total, p_partkey, s_suppkey LIMIT 10""")
def q_k_smallest_pairs(spark, d):
    return jn.k_smallest_pairs(table(spark, d, "part"), "p_partkey", "p_retailprice",
                               table(spark, d, "supplier"), "s_suppkey", "s_acctbal", 10)


@query("near_duplicates", f"""
WITH a AS (SELECT user_id, cents, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM {E}),
h AS (SELECT DISTINCT x.user_id FROM a x JOIN a y ON x.user_id = y.user_id AND x.rn - y.rn BETWEEN 1 AND 3
      AND abs(x.cents - y.cents) <= 100)
SELECT u.user_id, h.user_id IS NOT NULL AS has_near_duplicate
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN h ON h.user_id = u.user_id""")
def q_near_duplicates(spark, d):
    return jn.near_duplicates(events(spark, d), ["user_id"], ["ts", "event_id"], "cents", 3, 100)


@query("near_duplicate_values", f"""
WITH a AS (SELECT user_id, cents, lag(cents) OVER (PARTITION BY user_id ORDER BY cents) AS pv FROM {E})
SELECT user_id, coalesce(min(cents - pv) <= 0, false) AS has_near_duplicate FROM a GROUP BY 1""")
def q_near_duplicate_values(spark, d):
    return jn.near_duplicates(events(spark, d), ["user_id"], ["ts", "event_id"], "cents", None, 0)


@query("collision_check", f"""
WITH w AS (SELECT DISTINCT word FROM {_WORDS}),
a AS (SELECT word, CASE WHEN length(word) <= 2 THEN word
                   ELSE word[1] || CAST(length(word) - 2 AS VARCHAR) || word[-1:] END AS abbr FROM w)
SELECT a.word, a.abbr, n.n = 1 AS "unique" FROM a JOIN (SELECT abbr, count(*) AS n FROM a GROUP BY 1) n
  ON n.abbr = a.abbr""")
def q_collision_check(spark, d):
    return jn.collision_check(_doc_words(spark, d), "word", tx.abbreviation("word"))
