"""Grouping operators bound to the driver tables (survey 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import aggregates as ag
from ..sources.tables import table
from .registry import query

# The banned words used by the most-common-word query.
BANNED = ["the", "and", "of", "de", "la", "le", "et", "der", "die", "und", "el", "y"]

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]+"
HOST = r"^[a-z]+://([^/?#:]+)"


def _doc_words(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", F.explode(tx.words("text")).alias("word"))


_DOC_WORDS_SQL = r"""(SELECT doc_id, lang, word FROM (SELECT doc_id, lang,
    unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM documents) WHERE length(word) > 0)"""


@query("group_average", """
SELECT l_partkey, avg(l_quantity) AS avg_quantity FROM lineitem GROUP BY l_partkey""")
def q_group_average(spark, d):
    return ag.group_average(table(spark, d, "lineitem"), "l_partkey", "l_quantity", name="avg_quantity")


@query("top_members", """
SELECT l.l_partkey, b.best_quantity, l.l_suppkey
FROM lineitem l JOIN (SELECT l_partkey, max(l_quantity) AS best_quantity FROM lineitem GROUP BY 1) b
  ON l.l_partkey = b.l_partkey AND l.l_quantity = b.best_quantity""")
def q_top_members(spark, d):
    return ag.top_members(table(spark, d, "lineitem"), "l_partkey", "l_quantity", "l_suppkey",
                          best="best_quantity")


@query("top_k_frequent_words", f"""
SELECT word, count(*) AS n FROM {_DOC_WORDS_SQL} GROUP BY word ORDER BY n DESC, word LIMIT 20""")
def q_top_k_frequent_words(spark, d):
    return ag.top_k_frequent(_doc_words(spark, d), "word", 20)


@query("top_k_frequent_by_lang", f"""
SELECT lang, word, n, rank FROM (
  SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank
  FROM (SELECT lang, word, count(*) AS n FROM {_DOC_WORDS_SQL} GROUP BY lang, word))
WHERE rank <= 5""")
def q_top_k_frequent_by_lang(spark, d):
    return ag.top_k_frequent_by(_doc_words(spark, d), "lang", "word", 5)


@query("top_k_frequent_events", """
SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3""")
def q_top_k_frequent_events(spark, d):
    return ag.top_k_frequent(table(spark, d, "events"), "event_type", 3)


@query("most_common_word", r"""
SELECT lang, word, n FROM (
  SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM (
    SELECT lang, word, count(*) AS n FROM (
      SELECT lang, unnest(regexp_split_to_array(lower(text), '[\s!?'',;.]+')) AS word FROM documents)
    WHERE length(word) > 0
      AND word NOT IN ('the', 'and', 'of', 'de', 'la', 'le', 'et', 'der', 'die', 'und', 'el', 'y')
    GROUP BY lang, word))
WHERE r = 1""")
def q_most_common_word(spark, d):
    return ag.most_common_word(table(spark, d, "documents"), "text", BANNED, group="lang")


@query("suffix_rollup", rf"""
SELECT domain, count(*) AS visits FROM (
  SELECT unnest(list_transform(range(1, len(p) + 1), lambda i: array_to_string(p[i:], '.'))) AS domain
  FROM (SELECT string_split(regexp_extract(url, '{HOST}', 1), '.') AS p FROM pages))
GROUP BY domain""")
def q_suffix_rollup(spark, d):
    pages = table(spark, d, "pages").select(F.regexp_extract("url", HOST, 1).alias("host"))
    return ag.suffix_rollup(pages, "host")


@query("distinct_emails", rf"""
SELECT source, count(DISTINCT replace(split_part(split_part(e, '@', 1), '+', 1), '.', '')
                              || '@' || split_part(e, '@', 2)) AS n_emails
FROM (SELECT source, unnest(regexp_extract_all(text, '{EMAIL}')) AS e FROM documents)
GROUP BY source""")
def q_distinct_emails(spark, d):
    docs = table(spark, d, "documents")
    e = docs.select("source", F.explode(F.regexp_extract_all("text", F.lit(EMAIL), 0)).alias("e"))
    return ag.distinct_normalised(e, tx.email_normal_form("e"), ["source"], name="n_emails")


_MORSE_SQL = "[" + ", ".join(f"'{m}'" for m in tx.MORSE) + "]"


@query("distinct_morse", f"""
SELECT count(DISTINCT array_to_string(list_transform(string_split(w, ''),
         lambda ch: {_MORSE_SQL}[strpos('{tx.ALPHABET}', ch)]), '')) AS n_codes
FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS w FROM part)
WHERE regexp_matches(w, '^[a-z]+$')""")
def q_distinct_morse(spark, d):
    w = table(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("w"))
    w = w.where(F.col("w").rlike("^[a-z]+$"))
    return ag.distinct_normalised(w, tx.morse_code("w"), name="n_codes")


@query("heavy_hitters", """
SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1
HAVING count(*) > (SELECT count(*) FROM lineitem) // 3""")
def q_heavy_hitters(spark, d):
    return ag.heavy_hitters(table(spark, d, "lineitem"), "l_returnflag", 3)


@query("odd_count_items", """
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) % 2 <> 0""")
def q_odd_count_items(spark, d):
    return ag.odd_count_items(table(spark, d, "lineitem"), "l_partkey", 2)


@query("xor_fold", """
SELECT l_orderkey, bit_xor(l_partkey) AS xor FROM lineitem GROUP BY 1""")
def q_xor_fold(spark, d):
    return ag.xor_fold(table(spark, d, "lineitem"), ["l_orderkey"], "l_partkey")


@query("first_unique", """
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
f AS (SELECT e.user_id, arg_min(e.event_id, e.ts) AS fu FROM events e
      JOIN c ON e.user_id = c.user_id AND e.event_type = c.event_type WHERE c.n = 1 GROUP BY 1)
SELECT u.user_id, coalesce(f.fu, -1) AS first_unique
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN f ON u.user_id = f.user_id""")
def q_first_unique(spark, d):
    return ag.first_unique(table(spark, d, "events"), ["user_id"], "event_type", ["ts", "event_id"], "event_id")


@query("degree_span", """
WITH p AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
           FROM events),
i AS (SELECT user_id, event_type, count(*) AS n, max(pos) - min(pos) + 1 AS span FROM p GROUP BY 1, 2),
m AS (SELECT user_id, max(n) AS degree FROM i GROUP BY 1)
SELECT m.user_id, m.degree, min(i.span) AS span FROM m JOIN i ON i.user_id = m.user_id AND i.n = m.degree
GROUP BY 1, 2""")
def q_degree_span(spark, d):
    return ag.degree_span(table(spark, d, "events"), ["user_id"], "event_type", ["ts", "event_id"])


@query("group_anagrams", f"""
WITH w AS (SELECT DISTINCT array_to_string(list_sort(string_split(word, '')), '') AS signature, word
           FROM {_DOC_WORDS_SQL}),
s AS (SELECT signature, count(*) AS group_size FROM w GROUP BY 1 HAVING count(*) >= 2)
SELECT w.signature, w.word, s.group_size FROM w JOIN s ON w.signature = s.signature""")
def q_group_anagrams(spark, d):
    w = _doc_words(spark, d)
    return ag.group_by_signature(w, "word", tx.sorted_letters("word"))


@query("group_shifted", """
WITH w AS (SELECT DISTINCT array_to_string(list_transform(string_split(word, ''),
              lambda ch: lpad(CAST((((ascii(ch) - ascii(word)) % 26) + 26) % 26 AS VARCHAR), 2, '0')), ',') AS signature,
              word
           FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS word FROM part)
           WHERE regexp_matches(word, '^[a-z]+$')),
s AS (SELECT signature, count(*) AS group_size FROM w GROUP BY 1 HAVING count(*) >= 2)
SELECT w.signature, w.word, s.group_size FROM w JOIN s ON w.signature = s.signature""")
def q_group_shifted(spark, d):
    w = table(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("word"))
    w = w.where(F.col("word").rlike("^[a-z]+$"))
    return ag.group_by_signature(w, "word", tx.shift_signature("word"))


@query("bijection_check", """
WITH p AS (SELECT DISTINCT lang, source FROM documents)
SELECT 'lang' AS side, lang AS value, count(*) AS partners FROM p GROUP BY lang HAVING count(*) > 1
UNION ALL
SELECT 'source' AS side, source AS value, count(*) AS partners FROM p GROUP BY source HAVING count(*) > 1""")
def q_bijection_check(spark, d):
    return ag.bijection_check(table(spark, d, "documents"), "lang", "source")


@query("h_index", """
WITH c AS (SELECT l_partkey, l_quantity, count(*) AS c FROM lineitem GROUP BY 1, 2),
s AS (SELECT l_partkey, l_quantity,
             sum(c) OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC ROWS UNBOUNDED PRECEDING) AS ge FROM c)
SELECT l_partkey, CAST(greatest(max(least(CAST(floor(l_quantity) AS BIGINT), ge)), 0) AS BIGINT) AS h_index
FROM s GROUP BY 1""")
def q_h_index(spark, d):
    return ag.h_index(table(spark, d, "lineitem"), "l_partkey", "l_quantity")


@query("common_prefix", """
WITH g AS (SELECT p_brand, min(p_name) AS lo, max(p_name) AS hi FROM part GROUP BY 1)
SELECT p_brand, lo[1:coalesce(list_position(list_transform(range(1, least(length(lo), length(hi)) + 1),
                                                          lambda i: lo[i] = hi[i]), false) - 1,
                              least(length(lo), length(hi)))] AS prefix
FROM g""")
def q_common_prefix(spark, d):
    return ag.common_prefix(table(spark, d, "part"), "p_brand", "p_name")


@query("nth_distinct_max", """
WITH d AS (SELECT DISTINCT o_custkey, o_totalprice FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rn FROM d)
SELECT o_custkey, CASE WHEN max(rn) = 3 THEN min(o_totalprice) ELSE max(o_totalprice) END AS nth_max
FROM r WHERE rn <= 3 GROUP BY 1""")
def q_nth_distinct_max(spark, d):
    return ag.nth_distinct_max(table(spark, d, "orders"), "o_custkey", "o_totalprice", 3)


@query("second_min_distinct", """
WITH d AS (SELECT DISTINCT l_orderkey, l_quantity FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS rn FROM d)
SELECT l_orderkey, coalesce(max(CASE WHEN rn = 2 THEN l_quantity END), -1) AS second_min
FROM r WHERE rn <= 2 GROUP BY 1""")
def q_second_min_distinct(spark, d):
    return ag.second_min_distinct(table(spark, d, "lineitem"), "l_orderkey", "l_quantity")


@query("kth_largest", """
SELECT l_suppkey, max(CASE WHEN rn = 3 THEN l_extendedprice END) AS kth FROM (
  SELECT l_suppkey, l_extendedprice,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) AS rn FROM lineitem)
WHERE rn <= 3 GROUP BY 1""")
def q_kth_largest(spark, d):
    return ag.kth_largest(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice", 3)


@query("kth_largest_global", """
SELECT min(l_extendedprice) AS kth FROM (
  SELECT l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC LIMIT 10)""")
def q_kth_largest_global(spark, d):
    return ag.kth_largest(table(spark, d, "lineitem"), [], "l_extendedprice", 10)


@query("exact_median", """
WITH v AS (SELECT c_acctbal AS v FROM customer UNION ALL SELECT s_acctbal FROM supplier),
r AS (SELECT v, row_number() OVER (ORDER BY v) AS rn, count(*) OVER () AS n FROM v)
SELECT avg(v) AS median FROM r WHERE rn = (n + 1) // 2 OR rn = (n + 2) // 2""")
def q_exact_median(spark, d):
    v = (table(spark, d, "customer").select(F.col("c_acctbal").alias("v"))
         .unionAll(table(spark, d, "supplier").select(F.col("s_acctbal").alias("v"))))
    return ag.exact_median(v, "v")


@query("l1_meeting_point", """
WITH p AS (SELECT CAST(p_size AS BIGINT) AS x, CAST(floor(p_retailprice / 10) AS BIGINT) AS y FROM part),
mx AS (SELECT x AS median_x FROM (SELECT x, row_number() OVER (ORDER BY x) AS rn, count(*) OVER () AS n FROM p)
       WHERE rn = greatest(CAST(ceil(n / 2) AS BIGINT), 1)),
my AS (SELECT y AS median_y FROM (SELECT y, row_number() OVER (ORDER BY y) AS rn, count(*) OVER () AS n FROM p)
       WHERE rn = greatest(CAST(ceil(n / 2) AS BIGINT), 1))
SELECT median_x, median_y, CAST(sum(abs(x - median_x) + abs(y - median_y)) AS BIGINT) AS total_distance FROM p, mx, my
GROUP BY 1, 2""")
def q_l1_meeting_point(spark, d):
    p = table(spark, d, "part").select(F.col("p_size").cast("long").alias("x"),
                                       F.floor(F.col("p_retailprice") / 10).cast("long").alias("y"))
    return ag.l1_meeting_point(p, "x", "y")


@query("excess_over_min", """
SELECT l_orderkey, sum(l_quantity) - count(l_quantity) * min(l_quantity) AS excess FROM lineitem GROUP BY 1""")
def q_excess_over_min(spark, d):
    return ag.excess_over_min(table(spark, d, "lineitem"), "l_orderkey", "l_quantity")


@query("key_audit", """
SELECT kind, unit, value, count(*) AS n FROM (
  SELECT 'row' AS kind, CAST(l_orderkey AS VARCHAR) AS unit, l_suppkey AS value FROM lineitem
  UNION ALL SELECT 'col', CAST(l_linenumber AS VARCHAR), l_suppkey FROM lineitem
  UNION ALL SELECT 'box', CAST(l_orderkey // 3 AS VARCHAR) || ':' || CAST(l_linenumber // 3 AS VARCHAR), l_suppkey
  FROM lineitem)
GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def q_key_audit(spark, d):
    return ag.key_audit(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_suppkey")


@query("in_out_degree", """
WITH e AS (SELECT DISTINCT l_partkey AS s, l_suppkey AS d FROM lineitem WHERE l_partkey <> l_suppkey),
nodes AS (SELECT l_partkey AS node FROM lineitem UNION SELECT l_suppkey FROM lineitem),
o AS (SELECT s AS node, count(*) AS out_degree FROM e GROUP BY 1),
i AS (SELECT d AS node, count(*) AS in_degree FROM e GROUP BY 1)
SELECT n.node, coalesce(i.in_degree, 0) AS in_degree, coalesce(o.out_degree, 0) AS out_degree,
       coalesce(i.in_degree, 0) = (SELECT count(*) FROM nodes) - 1 AND coalesce(o.out_degree, 0) = 0 AS is_judge
FROM nodes n LEFT JOIN i ON n.node = i.node LEFT JOIN o ON n.node = o.node""")
def q_in_out_degree(spark, d):
    return ag.in_out_degree(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")
