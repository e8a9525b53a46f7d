"""Text jobs, CSV source/sink and predicates bound to the driver tables
(survey 2.1, 2.2, 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import predicates as pr
from ..operators import text as tj
from ..sources import csv as csvio
from ..sources.tables import table
from .registry import query
from .sequences import L, LORDER, lines

_PROPER_SQL = r"""array_to_string(list_transform(regexp_extract_all({c}, '(\p{{L}}+|[^\p{{L}}]+)'),
                  lambda p: upper(p[1]) || lower(p[2:])), '')"""


def _proper_sql(c: str) -> str:
    return _PROPER_SQL.format(c=c)


@query("proper_case", f"""
SELECT o_orderkey, {_proper_sql('o_orderpriority')} AS o_orderpriority, o_orderstatus FROM orders""")
def q_proper_case(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return pr.proper_case(o, ["o_orderpriority"])


@query("csv_round_trip", f"""
SELECT c_custkey, {_proper_sql('c_name')} AS c_name, c_nationkey, c_acctbal, {_proper_sql('c_mktsegment')}
       AS c_mktsegment FROM customer""")
def q_csv_round_trip(spark, d):
    """customer -> CSV (header, text fields) -> read back with an explicit
    all-text schema -> proper case on the text columns -> original types."""
    c = table(spark, d, "customer")
    back = csvio.round_trip(c, "customer-csv")
    cased = pr.proper_case(back, [f for f in back.columns[:7] if f in ("c_name", "c_mktsegment")])
    return cased.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in c.schema.fields])


@query("drop_values", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'R'""")
def q_drop_values(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return pr.drop_values(li, "l_returnflag", ["R"])


@query("rule_label", """
SELECT o_orderkey, CASE WHEN o_orderkey % 15 = 0 THEN 'FizzBuzz' WHEN o_orderkey % 5 = 0 THEN 'Buzz'
                        WHEN o_orderkey % 3 = 0 THEN 'Fizz' ELSE CAST(o_orderkey AS VARCHAR) END AS label
FROM orders""")
def q_rule_label(spark, d):
    return pr.rule_label(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("first_last_span", f"""
SELECT l_orderkey,
       CAST(CASE WHEN sum(CASE WHEN q = 25 THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN q < 25 THEN 1 ELSE 0 END)
            ELSE -1 END AS BIGINT) AS first_pos,
       CAST(CASE WHEN sum(CASE WHEN q = 25 THEN 1 ELSE 0 END) > 0 THEN sum(CASE WHEN q <= 25 THEN 1 ELSE 0 END) - 1
            ELSE -1 END AS BIGINT) AS last_pos
FROM {L} GROUP BY 1""")
def q_first_last_span(spark, d):
    return pr.first_last_span(lines(spark, d), ["l_orderkey"], "q", 25)


@query("insert_rank", """
SELECT p.p_partkey AS l_partkey, p.p_size, CAST(coalesce(sum(CASE WHEN l.l_quantity < p.p_size THEN 1 ELSE 0 END), 0)
       AS BIGINT) AS insert_pos
FROM part p LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey GROUP BY 1, 2""")
def q_insert_rank(spark, d):
    probes = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return pr.insert_rank(table(spark, d, "lineitem"), probes, "l_partkey", "l_quantity", "p_size")


@query("fixed_points", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, q, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY q, {", ".join(LORDER)}) - 1 AS pos FROM {L})
WHERE q = pos""")
def q_fixed_points(spark, d):
    r = pr.fixed_points(lines(spark, d), ["l_orderkey"], "q", LORDER)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "q", "pos")


@query("word_stats", r"""
SELECT lang, avg(n) AS avg_words, max(n) AS max_words, avg(last) AS avg_last_word FROM (
  SELECT lang, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n,
         length(regexp_extract(text, '(\S+)\s*$', 1)) AS last FROM documents) GROUP BY lang""")
def q_word_stats(spark, d):
    r = tj.word_stats(table(spark, d, "documents"), "text", "lang")
    return r.withColumn("max_words", F.col("max_words").cast("long"))


@query("url_normalise", f"""
WITH u AS (SELECT translate(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1), '{tj.UPPER}', '{tj.LOWER}') AS host,
                  regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages),
c AS (SELECT host, list_reduce(list_prepend('', string_split(path, '/')),
        lambda acc, s: CASE WHEN s = '' OR s = '.' THEN acc WHEN s = '..' THEN regexp_replace(acc, '/[^/]*$', '')
                            ELSE acc || '/' || s END) AS p FROM u)
SELECT host || CASE WHEN p = '' THEN '/' ELSE p END AS canonical, replace(host, '.', '[.]') AS host_defanged,
       count(*) AS n_pages FROM c GROUP BY 1, 2""")
def q_url_normalise(spark, d):
    return tj.url_normalise(table(spark, d, "pages"), "url")


@query("version_max", """
WITH v AS (SELECT l_suppkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR)
                  || '.' || CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS version FROM lineitem),
k AS (SELECT l_suppkey, version, list_transform(string_split(version, '.'), lambda x: CAST(x AS INTEGER)) AS p FROM v)
SELECT l_suppkey, arg_max(version, list_concat(p, list_transform(range(greatest(4 - len(p), 0)), lambda x: 0)))
       AS max_version FROM k GROUP BY 1""")
def q_version_max(spark, d):
    li = table(spark, d, "lineitem")
    v = li.select("l_suppkey", F.concat_ws(".", F.col("l_quantity").cast("int").cast("string"),
                                           F.col("l_linenumber").cast("string"),
                                           F.round(F.col("l_tax") * 100).cast("int").cast("string")).alias("version"))
    return tj.version_max(v, "l_suppkey", "version")


@query("numeric_audit", rf"""
SELECT source, count(*) AS n_tokens, CAST(sum(CASE WHEN regexp_matches(t, '{tj.NUMBER}') THEN 1 ELSE 0 END) AS BIGINT)
       AS n_numeric
FROM (SELECT source, unnest(regexp_split_to_array(trim(text), '\s+')) AS t FROM documents) WHERE t <> ''
GROUP BY source""")
def q_numeric_audit(spark, d):
    return tj.numeric_audit(table(spark, d, "documents"), "text", "source")


@query("numeric_rejects", rf"""
SELECT source, t AS token, count(*) AS n
FROM (SELECT source, unnest(regexp_split_to_array(trim(text), '\s+')) AS t FROM documents)
WHERE regexp_matches(t, '[0-9]') AND NOT regexp_matches(t, '{tj.NUMBER}') GROUP BY source, t""")
def q_numeric_rejects(spark, d):
    return tj.numeric_rejects(table(spark, d, "documents"), "text", "source")


@query("leading_integer", r"""
WITH t AS (SELECT source, unnest(regexp_split_to_array(text, '\s+')) AS t FROM documents),
m AS (SELECT source, regexp_extract(t, '^\s*([+-]?[0-9]+)', 1) AS m FROM t WHERE t <> ''),
v AS (SELECT source, CASE WHEN m = '' THEN 0
                          WHEN TRY_CAST(m AS HUGEINT) IS NULL THEN CASE WHEN m LIKE '-%' THEN -2147483648 ELSE 2147483647 END
                          ELSE greatest(least(TRY_CAST(m AS HUGEINT), 2147483647), -2147483648) END AS v FROM m)
SELECT source, CAST(sum(CASE WHEN v <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_parsed, CAST(sum(v) AS BIGINT) AS total
FROM v GROUP BY source""")
def q_leading_integer(spark, d):
    t = table(spark, d, "documents").select("source", F.explode(F.split("text", r"\s+")).alias("t")).where("t != ''")
    v = t.select("source", tj.leading_integer(F.col("t")).alias("v"))
    return v.groupBy("source").agg(F.sum(F.when(F.col("v") != 0, 1).otherwise(0)).cast("long").alias("n_parsed"),
                                   F.sum("v").cast("long").alias("total"))
