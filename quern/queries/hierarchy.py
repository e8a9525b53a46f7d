"""Hierarchy operators bound to the driver tables (survey 2.10).

Tree A: part, parent = key div 2, value = p_size.  Tree B (second tree for
comparisons): supplier, parent = key div 2, value = s_nationkey.  Tree A'
(the changed copy): tree A with sizes above 45 raised by one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hierarchy as hi
from ..sources.tables import table
from .registry import query

_PART_SRC = """SELECT CAST(p_partkey AS BIGINT) AS id, CASE WHEN p_partkey // 2 <> p_partkey THEN p_partkey // 2 END AS parent,
       CASE WHEN p_partkey % 2 = 0 THEN 'L' ELSE 'R' END AS side, CAST(p_size AS BIGINT) AS val FROM part"""
_PART2_SRC = """SELECT CAST(p_partkey AS BIGINT) AS id, CASE WHEN p_partkey // 2 <> p_partkey THEN p_partkey // 2 END AS parent,
       CASE WHEN p_partkey % 2 = 0 THEN 'L' ELSE 'R' END AS side,
       CAST(CASE WHEN p_size > 45 THEN p_size + 1 ELSE p_size END AS BIGINT) AS val FROM part"""
_SUPP_SRC = """SELECT CAST(s_suppkey AS BIGINT) AS id, CASE WHEN s_suppkey // 2 <> s_suppkey THEN s_suppkey // 2 END AS parent,
       CASE WHEN s_suppkey % 2 = 0 THEN 'L' ELSE 'R' END AS side, CAST(s_nationkey AS BIGINT) AS val FROM supplier"""


def tree_cte(name: str, src: str) -> str:
    """Recursive CTE (under WITH RECURSIVE) with the columns of tree_paths."""
    return f"""{name}_n AS ({src}),
{name}(id, parent, side, val, level, code, anc, psum, prefixes, run, digits, path_text) AS (
  SELECT id, parent, side, val, 0, '', [id], val, [CAST(0 AS BIGINT)], CAST(1 AS BIGINT), val % 10, CAST(val AS VARCHAR)
  FROM {name}_n WHERE parent IS NULL OR parent NOT IN (SELECT id FROM {name}_n)
  UNION ALL
  SELECT n.id, n.parent, n.side, n.val, t.level + 1, t.code || CASE WHEN n.side = 'L' THEN '0' ELSE '1' END,
         list_append(t.anc, n.id), t.psum + n.val, list_append(t.prefixes, t.psum),
         CASE WHEN n.val = t.val + 1 THEN t.run + 1 ELSE 1 END, t.digits * 10 + n.val % 10,
         t.path_text || '->' || CAST(n.val AS VARCHAR)
  FROM {name} t JOIN {name}_n n ON n.parent = t.id)"""


_A = tree_cte("ta", _PART_SRC)
_LEAVES_A = "(SELECT * FROM ta WHERE id NOT IN (SELECT parent FROM ta WHERE parent IS NOT NULL))"


def _paths_a(spark, d, codes=False):
    return hi.tree_paths(hi.binary_heap_tree(table(spark, d, "part"), "p_partkey", F.col("p_size")), codes)


def _paths_a2(spark, d):
    p = table(spark, d, "part")
    return hi.tree_paths(hi.binary_heap_tree(
        p, "p_partkey", F.when(F.col("p_size") > 45, F.col("p_size") + 1).otherwise(F.col("p_size"))))


def _paths_b(spark, d, codes=False):
    return hi.tree_paths(hi.binary_heap_tree(table(spark, d, "supplier"), "s_suppkey", F.col("s_nationkey")), codes)


@query("tree_levels", f"""
WITH RECURSIVE {_A}
SELECT id, CAST(level AS BIGINT) AS level, row_number() OVER (PARTITION BY level ORDER BY code, id) AS pos_in_level,
       CASE WHEN level % 2 = 1 THEN count(*) OVER (PARTITION BY level) - row_number() OVER (PARTITION BY level
            ORDER BY code, id) + 1 ELSE row_number() OVER (PARTITION BY level ORDER BY code, id) END AS zigzag_pos,
       lead(id) OVER (PARTITION BY level ORDER BY code, id) AS right_neighbour
FROM ta""")
def q_tree_levels(spark, d):
    return hi.tree_levels(_paths_a(spark, d))


@query("tree_summary", f"""
WITH RECURSIVE {_A}
SELECT CAST((SELECT max(level) + 1 FROM ta) AS BIGINT) AS max_depth,
       CAST((SELECT sum(val * (level + 1)) FROM ta) AS BIGINT) AS weighted_sum,
       CAST((SELECT min(level) + 1 FROM {_LEAVES_A}) AS BIGINT) AS min_leaf_depth,
       CAST((SELECT coalesce(sum(CASE WHEN side = 'L' THEN val END), 0) FROM {_LEAVES_A}) AS BIGINT) AS left_leaf_sum,
       CAST((SELECT sum(digits) FROM {_LEAVES_A}) AS BIGINT) AS digit_sum""")
def q_tree_summary(spark, d):
    return hi.tree_summary(_paths_a(spark, d))


@query("root_paths", f"""
WITH RECURSIVE {_A}
SELECT id, path_text, psum AS path_sum, psum = 150 AS hits_target, digits AS digit_number FROM {_LEAVES_A}""")
def q_root_paths(spark, d):
    return hi.root_paths(_paths_a(spark, d), 150).drop("digit_text")


@query("segment_paths", f"""
WITH RECURSIVE {_A}
SELECT id, CAST(len(list_filter(prefixes, lambda p: psum - p = 60)) AS BIGINT) AS n_paths, run FROM ta""")
def q_segment_paths(spark, d):
    return hi.segment_paths(_paths_a(spark, d), 60)


def _subtree_sql(levels: int = 40) -> str:
    ctes = [f"h{levels + 1} AS (SELECT CAST(NULL AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent, "
            f"CAST(NULL AS VARCHAR) AS side, CAST(NULL AS BIGINT) AS height, CAST(NULL AS BIGINT) AS gain WHERE false)"]
    for lv in range(levels, -1, -1):
        ctes.append(f"""h{lv} AS (
  SELECT t.id, t.parent, t.side, greatest(coalesce(k.hl, -1), coalesce(k.hr, -1)) + 1 AS height,
         abs(coalesce(k.hl, -1) - coalesce(k.hr, -1)) <= 1 AS balanced,
         coalesce(k.hl, -1) + coalesce(k.hr, -1) + 2 AS diameter_through,
         t.val + greatest(greatest(coalesce(k.gl, 0), 0), greatest(coalesce(k.gr, 0), 0)) AS gain,
         t.val + greatest(coalesce(k.gl, 0), 0) + greatest(coalesce(k.gr, 0), 0) AS best_path_through
  FROM ta t LEFT JOIN (SELECT parent, max(CASE WHEN side = 'L' THEN height END) AS hl,
                              max(CASE WHEN side = 'R' THEN height END) AS hr,
                              max(CASE WHEN side = 'L' THEN gain END) AS gl,
                              max(CASE WHEN side = 'R' THEN gain END) AS gr FROM h{lv + 1} GROUP BY parent) k
    ON k.parent = t.id WHERE t.level = {lv})""")
    union = " UNION ALL ".join(f"SELECT id, height, balanced, diameter_through, gain, best_path_through FROM h{lv}"
                               for lv in range(levels, -1, -1))
    return ",\n".join(ctes) + f"\nSELECT id, CAST(height AS BIGINT) AS height, balanced, " \
                              f"CAST(diameter_through AS BIGINT) AS diameter_through, CAST(gain AS BIGINT) AS gain, " \
                              f"CAST(best_path_through AS BIGINT) AS best_path_through FROM ({union})"


@query("subtree_stats", f"""
WITH RECURSIVE {_A},
{_subtree_sql()}""")
def q_subtree_stats(spark, d):
    return hi.subtree_stats(_paths_a(spark, d))


@query("lowest_common_ancestor", f"""
WITH RECURSIVE {_A},
pr AS (SELECT l_orderkey, min(l_partkey) AS a, max(l_partkey) AS b FROM lineitem GROUP BY 1)
SELECT pr.l_orderkey, pr.a, pr.b,
       x.anc[len(list_filter(range(1, least(len(x.anc), len(y.anc)) + 1), lambda i: x.anc[i] = y.anc[i]))] AS lca
FROM pr JOIN ta x ON x.id = pr.a JOIN ta y ON y.id = pr.b""")
def q_lowest_common_ancestor(spark, d):
    pairs = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("a"),
                                                                  F.max("l_partkey").alias("b"))
    return hi.lowest_common_ancestor(_paths_a(spark, d), pairs, "a", "b")


@query("leaf_order", f"""
WITH RECURSIVE {_A}
SELECT id, val, side, row_number() OVER (ORDER BY code, id) AS leaf_pos FROM {_LEAVES_A}""")
def q_leaf_order(spark, d):
    return hi.leaf_order(_paths_a(spark, d))


@query("leaf_similar", f"""
WITH RECURSIVE {_A}, {tree_cte("tb", _SUPP_SRC)},
la AS (SELECT val AS va, row_number() OVER (ORDER BY code, id) AS leaf_pos FROM {_LEAVES_A}),
lb AS (SELECT val AS vb, row_number() OVER (ORDER BY code, id) AS leaf_pos
       FROM tb WHERE id NOT IN (SELECT parent FROM tb WHERE parent IS NOT NULL)),
j AS (SELECT coalesce(la.leaf_pos, lb.leaf_pos) AS leaf_pos, va, vb FROM la FULL OUTER JOIN lb ON la.leaf_pos = lb.leaf_pos)
SELECT coalesce(bool_and(va IS NOT DISTINCT FROM vb), true) AS similar, count(va) AS n_leaves_a, count(vb) AS n_leaves_b,
       min(CASE WHEN va IS DISTINCT FROM vb THEN leaf_pos END) AS first_difference FROM j""")
def q_leaf_similar(spark, d):
    return hi.leaf_similar(_paths_a(spark, d), _paths_b(spark, d))


@query("traversal_order", f"""
WITH RECURSIVE {_A}
SELECT id, val, row_number() OVER (ORDER BY code, id) AS pre_pos,
       row_number() OVER (ORDER BY translate(code, '1', '2') || '1', id) AS in_pos,
       row_number() OVER (ORDER BY code || '2', id) AS post_pos FROM ta""")
def q_traversal_order(spark, d):
    return hi.traversal_order(_paths_a(spark, d))


@query("is_search_tree", f"""
WITH RECURSIVE {_A},
o AS (SELECT val, lag(val) OVER (ORDER BY translate(code, '1', '2') || '1', id) AS pv FROM ta)
SELECT coalesce(bool_and(pv IS NULL OR val > pv), true) AS is_search_tree FROM o""")
def q_is_search_tree(spark, d):
    return hi.is_search_tree(hi.traversal_order(_paths_a(spark, d)))


@query("tree_compare", f"""
WITH RECURSIVE {_A}, {tree_cte("tc", _PART2_SRC)},
eq AS (SELECT bool_and(a.val IS NOT DISTINCT FROM c.val) AS equal FROM ta a FULL OUTER JOIN tc c ON a.code = c.code),
mi AS (SELECT bool_and(a.val IS NOT DISTINCT FROM c.val) AS mirror FROM ta a
       FULL OUTER JOIN (SELECT translate(code, '01', '10') AS code, val FROM tc) c ON a.code = c.code),
sa AS (SELECT x.anc_id AS id, string_agg(x.rel || ':' || CAST(x.val AS VARCHAR), ',' ORDER BY x.rel) AS shape
       FROM (SELECT unnest(anc) AS anc_id, generate_subscripts(anc, 1) AS i, code, val FROM ta) q,
            LATERAL (SELECT q.anc_id, q.code[q.i:] AS rel, q.val) x GROUP BY x.anc_id),
sc AS (SELECT x.anc_id AS id, string_agg(x.rel || ':' || CAST(x.val AS VARCHAR), ',' ORDER BY x.rel) AS shape
       FROM (SELECT unnest(anc) AS anc_id, generate_subscripts(anc, 1) AS i, code, val FROM tc) q,
            LATERAL (SELECT q.anc_id, q.code[q.i:] AS rel, q.val) x GROUP BY x.anc_id)
SELECT (SELECT equal FROM eq) AS equal, (SELECT mirror FROM mi) AS mirror,
       (SELECT count(*) FROM sc WHERE shape IN (SELECT shape FROM sa)) AS b_subtrees_in_a""")
def q_tree_compare(spark, d):
    return hi.tree_compare(_paths_a(spark, d), _paths_a2(spark, d))


@query("merge_trees", f"""
WITH RECURSIVE {_A}, {tree_cte("tb", _SUPP_SRC)}
SELECT coalesce(a.code, b.code) AS code, coalesce(a.val, 0) + coalesce(b.val, 0) AS val
FROM ta a FULL OUTER JOIN tb b ON a.code = b.code""")
def q_merge_trees(spark, d):
    return hi.merge_trees(_paths_a(spark, d, codes=True), _paths_b(spark, d, codes=True))


def _outline_lines(spark, d):
    """One outline line per URL part: scheme (level 0), host, path segments,
    then the page file ``page_<id>.html``; a tab per level."""
    p = table(spark, d, "pages")
    scheme = F.regexp_extract("url", r"^([A-Za-z]+)://", 1)
    host = F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]+)", 1)
    path = F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1)
    segs = F.filter(F.split(path, "/"), lambda s: s != "")
    parts = F.concat(F.array(scheme, host), segs,
                     F.array(F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html"))))
    e = p.select("page_id", F.posexplode(parts).alias("i", "name"))
    return e.select((F.col("page_id") * 2147483648 + F.col("i")).alias("line_no"),
                    F.concat(F.repeat(F.lit("\t"), F.col("i")), F.col("name")).alias("line"))


_OUTLINE_SQL = r"""
WITH RECURSIVE pg AS (SELECT page_id, list_concat([regexp_extract(url, '^([A-Za-z]+)://', 1),
                                         regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)],
                           list_filter(string_split(regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), '/'),
                                       lambda s: s <> ''),
                           ['page_' || CAST(page_id AS VARCHAR) || '.html']) AS parts FROM pages),
ln AS (SELECT page_id * 2147483648 + i - 1 AS ln, CAST(i - 1 AS BIGINT) AS lvl, parts[i] AS name
       FROM pg, LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)),
par AS (SELECT l.ln, l.lvl, l.name, p.ln AS parent FROM ln l ASOF LEFT JOIN ln p ON p.lvl = l.lvl - 1 AND p.ln < l.ln),
pth(ln, path) AS (SELECT ln, name FROM par WHERE lvl = 0
                  UNION ALL SELECT par.ln, pth.path || '/' || par.name FROM pth JOIN par ON par.parent = pth.ln)"""


@query("outline_paths", _OUTLINE_SQL + """
SELECT par.ln AS line_no, par.lvl, par.name, pth.path, contains(par.name, '.') AS is_file,
       CAST(length(pth.path) AS BIGINT) AS path_length
FROM par LEFT JOIN pth ON pth.ln = par.ln""")
def q_outline_paths(spark, d):
    return hi.outline_paths(_outline_lines(spark, d))


@query("longest_file_path", _OUTLINE_SQL + """
SELECT CAST(coalesce(max(length(pth.path)), 0) AS BIGINT) AS longest FROM par JOIN pth ON pth.ln = par.ln
WHERE contains(par.name, '.')""")
def q_longest_file_path(spark, d):
    o = hi.outline_paths(_outline_lines(spark, d))
    return o.where("is_file").agg(F.coalesce(F.max("path_length"), F.lit(0)).cast("long").alias("longest"))
