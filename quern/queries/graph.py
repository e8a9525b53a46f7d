"""Graph operators bound to the driver tables (survey 2.9).

Oracles use DuckDB recursive CTEs (``USING KEY`` keeps one row per node and
improves it, the way the Spark loops do round by round)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph as gr
from ..plans.scan import previous
from ..sources.tables import table
from .registry import query

# Node ids of the part-supplier graph: part p -> 2p, supplier s -> 2s + 1.
_PS_SQL = """(SELECT DISTINCT 2 * l_partkey AS u, 2 * l_suppkey + 1 AS v FROM lineitem)"""


def _ps_edges(spark, d):
    li = table(spark, d, "lineitem")
    return li.select((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"))


@query("connected_components", f"""
WITH RECURSIVE e AS {_PS_SQL},
und AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
cc(node, comp) USING KEY (node) AS (
  SELECT DISTINCT u, u FROM und
  UNION
  SELECT n.node, n.m FROM (SELECT x.v AS node, min(c.comp) AS m FROM cc c JOIN und x ON x.u = c.node GROUP BY x.v) n
  JOIN recurring.cc r ON r.node = n.node WHERE n.m < r.comp)
SELECT node, comp FROM cc""")
def q_connected_components(spark, d):
    return gr.connected_components(_ps_edges(spark, d))


@query("incremental_components", f"""
WITH RECURSIVE e AS {_PS_SQL},
und AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
cc(node, comp) USING KEY (node) AS (
  SELECT DISTINCT u, u FROM und
  UNION
  SELECT n.node, n.m FROM (SELECT x.v AS node, min(c.comp) AS m FROM cc c JOIN und x ON x.u = c.node GROUP BY x.v) n
  JOIN recurring.cc r ON r.node = n.node WHERE n.m < r.comp)
SELECT node, comp FROM cc""")
def q_incremental_components(spark, d):
    """Labels of the lines shipped before 1998, then the later lines merged in
    starting from those labels: equal to the components of all lines."""
    li = table(spark, d, "lineitem")
    early = li.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    late = li.where(~(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")) | F.col("l_shipdate").isNull())

    def edges(x):
        return x.select((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"))

    saved = gr.connected_components(edges(early))
    # spanning edges of the saved components: each node to its label
    star = saved.where(F.col("node") != F.col("comp")).select(F.col("node").alias("src"), F.col("comp").alias("dst"))
    return gr.connected_components(edges(late).unionByName(star), initial=saved)


@query("component_sizes", f"""
WITH RECURSIVE e AS {_PS_SQL},
und AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
cc(node, comp) USING KEY (node) AS (
  SELECT DISTINCT u, u FROM und
  UNION
  SELECT n.node, n.m FROM (SELECT x.v AS node, min(c.comp) AS m FROM cc c JOIN und x ON x.u = c.node GROUP BY x.v) n
  JOIN recurring.cc r ON r.node = n.node WHERE n.m < r.comp)
SELECT comp, count(*) AS size FROM cc GROUP BY comp""")
def q_component_sizes(spark, d):
    return gr.component_sizes(gr.connected_components(_ps_edges(spark, d)))


_WORDS = r"""(SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM {t})
            WHERE w <> '')"""


def _all_words(spark, d, t):
    from ..functions.text import words
    w = table(spark, d, t).select(F.explode(words("text", "[^a-z]+")).alias("w"))
    return w.where(F.col("w") != "").distinct()


@query("bfs_distance", f"""
WITH RECURSIVE w AS {_WORDS.format(t="documents")},
pos AS (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM w),
pat AS (SELECT w, w[1:i - 1] || '*' || w[i + 1:] AS p FROM pos),
e AS (SELECT DISTINCT a.w AS s, b.w AS d FROM pat a JOIN pat b ON a.p = b.p AND a.w <> b.w),
src AS (SELECT w AS node FROM w WHERE w IN (SELECT w FROM {_WORDS.format(t="benchmark")})),
dist(node, d) USING KEY (node) AS (
  SELECT node, 0 FROM src
  UNION
  SELECT n.node, n.c FROM (SELECT e.d AS node, min(dist.d + 1) AS c FROM dist JOIN e ON e.s = dist.node GROUP BY e.d) n
  LEFT JOIN recurring.dist r ON r.node = n.node WHERE r.d IS NULL OR n.c < r.d),
np(node, d, n) AS (
  SELECT node, 0, CAST(1 AS BIGINT) FROM src
  UNION ALL
  SELECT x.d, np.d + 1, sum(np.n) FROM np JOIN e x ON x.s = np.node JOIN dist ON dist.node = x.d AND dist.d = np.d + 1
  GROUP BY x.d, np.d + 1)
SELECT w.w AS node, CAST(dist.d AS BIGINT) AS dist, CAST(np.n AS BIGINT) AS paths
FROM w LEFT JOIN dist ON dist.node = w.w LEFT JOIN np ON np.node = w.w""")
def q_bfs_distance(spark, d):
    w = _all_words(spark, d, "documents")
    e = gr.one_letter_edges(w, "w")
    src = w.join(_all_words(spark, d, "benchmark"), "w", "left_semi")
    return gr.bfs_distance(e, src, nodes=w)


@query("shortest_path_edges", f"""
WITH RECURSIVE w AS {_WORDS.format(t="documents")},
pos AS (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM w),
pat AS (SELECT w, w[1:i - 1] || '*' || w[i + 1:] AS p FROM pos),
e AS (SELECT DISTINCT a.w AS s, b.w AS d FROM pat a JOIN pat b ON a.p = b.p AND a.w <> b.w),
src AS (SELECT w AS node FROM w WHERE w IN (SELECT w FROM {_WORDS.format(t="benchmark")})),
dist(node, d) USING KEY (node) AS (
  SELECT node, 0 FROM src
  UNION
  SELECT n.node, n.c FROM (SELECT e.d AS node, min(dist.d + 1) AS c FROM dist JOIN e ON e.s = dist.node GROUP BY e.d) n
  LEFT JOIN recurring.dist r ON r.node = n.node WHERE r.d IS NULL OR n.c < r.d),
fin AS (SELECT node, d FROM dist),
onward AS (SELECT e.s, e.d, b.d AS dist FROM e JOIN fin a ON a.node = e.s JOIN fin b ON b.node = e.d WHERE b.d = a.d + 1),
back(s, d, dist) AS (
  SELECT s, d, dist FROM onward WHERE length(d) > 4
  UNION
  SELECT o.s, o.d, o.dist FROM back JOIN onward o ON o.d = back.s)
SELECT s AS src, d AS dst, CAST(dist AS BIGINT) AS dist FROM back""")
def q_shortest_path_edges(spark, d):
    """Edges of all shortest one-letter ladders from the benchmark's words to
    words of more than four letters."""
    w = _all_words(spark, d, "documents")
    src = w.join(_all_words(spark, d, "benchmark"), "w", "left_semi")
    return gr.shortest_path_edges(gr.one_letter_edges(w, "w"), src, w.where(F.length("w") > 4))


# Weighted directed graph: part -> supplier costs the quantity, supplier ->
# part costs the discount in percent plus one (least weight per pair).
_WE_SQL = """(SELECT s, d, min(w) AS w FROM (
    SELECT 2 * l_partkey AS s, 2 * l_suppkey + 1 AS d, CAST(l_quantity AS BIGINT) AS w FROM lineitem
    UNION ALL
    SELECT 2 * l_suppkey + 1, 2 * l_partkey, CAST(round(l_discount * 100) AS BIGINT) + 1 FROM lineitem) GROUP BY 1, 2)"""


def _weighted(spark, d):
    li = table(spark, d, "lineitem")
    a = li.select((F.col("l_partkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst"),
                  F.col("l_quantity").cast("long").alias("w"))
    b = li.select((F.col("l_suppkey") * 2 + 1).alias("src"), (F.col("l_partkey") * 2).alias("dst"),
                  (F.round(F.col("l_discount") * 100).cast("long") + 1).alias("w"))
    return a.unionByName(b)


def _source(spark, d):
    """The source node: the part with the least key that has lines."""
    li = table(spark, d, "lineitem")
    return li.agg((F.min("l_partkey") * 2).alias("node"))


_DIST_SQL = f"""
WITH RECURSIVE e AS {_WE_SQL},
dist(node, dist) USING KEY (node) AS (
  SELECT 2 * min(l_partkey), CAST(0 AS BIGINT) FROM lineitem
  UNION
  SELECT n.node, n.c FROM (SELECT e.d AS node, min(dist.dist + e.w) AS c FROM dist JOIN e ON e.s = dist.node
                           GROUP BY e.d) n
  LEFT JOIN recurring.dist r ON r.node = n.node WHERE r.dist IS NULL OR n.c < r.dist)"""


@query("shortest_paths", _DIST_SQL + """
SELECT node, dist FROM dist""")
def q_shortest_paths(spark, d):
    return gr.shortest_paths(_weighted(spark, d), _source(spark, d))


@query("network_delay", _DIST_SQL + """,
nodes AS (SELECT s AS node FROM e UNION SELECT d FROM e)
SELECT CASE WHEN count(*) FILTER (WHERE dist.node IS NULL) > 0 THEN -1 ELSE max(dist.dist) END AS delay
FROM nodes LEFT JOIN dist ON dist.node = nodes.node""")
def q_network_delay(spark, d):
    e = _weighted(spark, d)
    nodes = e.select(F.col("src").alias("node")).unionByName(e.select(F.col("dst").alias("node")))
    return gr.delay_answer(gr.shortest_paths(e, _source(spark, d)), nodes)


@query("bounded_hop_paths", f"""
WITH e AS {_WE_SQL},
b0 AS (SELECT 2 * min(l_partkey) AS node, CAST(0 AS BIGINT) AS cost FROM lineitem),
b1 AS (SELECT node, min(cost) AS cost FROM (SELECT * FROM b0 UNION ALL
        SELECT e.d, b0.cost + e.w FROM b0 JOIN e ON e.s = b0.node) GROUP BY node),
b2 AS (SELECT node, min(cost) AS cost FROM (SELECT * FROM b1 UNION ALL
        SELECT e.d, b1.cost + e.w FROM b1 JOIN e ON e.s = b1.node) GROUP BY node),
b3 AS (SELECT node, min(cost) AS cost FROM (SELECT * FROM b2 UNION ALL
        SELECT e.d, b2.cost + e.w FROM b2 JOIN e ON e.s = b2.node) GROUP BY node)
SELECT node, cost FROM b3""")
def q_bounded_hop_paths(spark, d):
    return gr.bounded_hop_paths(_weighted(spark, d), _source(spark, d), k=2)


@query("topo_layers", """
WITH RECURSIVE e AS (SELECT DISTINCT p_partkey // 2 AS s, p_partkey AS d FROM part WHERE p_partkey // 2 <> p_partkey),
nodes AS (SELECT s AS node FROM e UNION SELECT d FROM e),
lay(node, layer) AS (
  SELECT node, 0 FROM nodes WHERE node NOT IN (SELECT d FROM e)
  UNION ALL
  SELECT e.d, lay.layer + 1 FROM lay JOIN e ON e.s = lay.node)
SELECT nodes.node, CAST(max(lay.layer) AS BIGINT) AS layer, max(lay.layer) IS NULL AS in_cycle
FROM nodes LEFT JOIN lay ON lay.node = nodes.node GROUP BY nodes.node""")
def q_topo_layers(spark, d):
    p = table(spark, d, "part").select(F.floor(F.col("p_partkey") / 2).cast("long").alias("src"),
                                       F.col("p_partkey").alias("dst"))
    return gr.topo_layers(p.where(F.col("src") != F.col("dst")))


def _levels_sql(n_levels: int = 40) -> str:
    parts = ["j0 AS (SELECT x, y, least(x, y) AS lab FROM f)"]
    for j in range(1, n_levels):
        parts.append(f"j{j} AS (SELECT a.x, b.y, least(a.lab, b.lab) AS lab FROM j{j - 1} a JOIN j{j - 1} b ON b.x = a.y)")
    return ",\n".join(parts)


@query("pointer_cycles", f"""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM orders),
f AS (SELECT o_orderkey AS x, (o_orderkey * o_orderkey + 1) % (SELECT n FROM n) AS y FROM orders),
{_levels_sql()},
cyc AS (SELECT DISTINCT y AS x FROM j39),
walk(start, node, t) AS (
  SELECT x, x, 0 FROM f WHERE x NOT IN (SELECT x FROM cyc)
  UNION ALL
  SELECT walk.start, f.y, walk.t + 1 FROM walk JOIN f ON f.x = walk.node WHERE walk.node NOT IN (SELECT x FROM cyc)),
tails AS (SELECT start, max(t) AS tail, arg_max(node, t) AS entry FROM walk GROUP BY start)
SELECT f.x AS node, f.x IN (SELECT x FROM cyc) AS on_cycle, CAST(coalesce(tails.tail, 0) AS BIGINT) AS tail,
       coalesce(tails.entry, f.x) AS entry, j39.lab AS cycle_label
FROM f LEFT JOIN tails ON tails.start = f.x LEFT JOIN j39 ON j39.x = coalesce(tails.entry, f.x)""")
def q_pointer_cycles(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("node"))
    n = o.select(F.count(F.lit(1)))
    f = o.select("node", ((F.col("node") * F.col("node") + 1) % n.scalar()).alias("next"))
    return gr.pointer_cycles(f)


@query("circular_array_loop", f"""
WITH RECURSIVE n AS (SELECT count(*) AS n FROM orders),
st AS (SELECT o_orderkey AS x, CAST(round(o_totalprice * 100) AS BIGINT) % 7 - 3 AS step FROM orders),
f AS (SELECT x, ((x + step) % (SELECT n FROM n) + (SELECT n FROM n)) % (SELECT n FROM n) AS y FROM st),
{_levels_sql()},
cyc AS (SELECT DISTINCT y AS x FROM j39)
SELECT j39.lab AS cycle, count(*) AS length,
       count(*) > 1 AND min(sign(st.step)) = max(sign(st.step)) AND min(sign(st.step)) <> 0 AS valid
FROM cyc JOIN j39 ON j39.x = cyc.x JOIN st ON st.x = cyc.x GROUP BY j39.lab""")
def q_circular_array_loop(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("node"), (F.round(F.col("o_totalprice") * 100).cast("long") % 7 - 3).alias("step"))
    return gr.circular_loops(o)


@query("chain_rank", """
WITH r AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rank,
                  count(*) OVER (PARTITION BY user_id) AS length,
                  last_value(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS tail
           FROM events)
SELECT event_id AS node, tail, length, rank, length - rank + 1 AS reversed_pos,
       CASE WHEN rank % 2 = 1 THEN (rank + 1) // 2 ELSE CAST(ceil(length / 2) AS BIGINT) + rank // 2 END AS odd_even_pos,
       CASE WHEN rank % 2 = 1 AND rank < length THEN rank + 1 WHEN rank % 2 = 0 THEN rank - 1 ELSE rank END
         AS swapped_pos,
       CASE WHEN rank <= CAST(ceil(length / 2) AS BIGINT) THEN 2 * rank - 1 ELSE 2 * (length - rank + 1) END AS folded_pos,
       rank = length // 2 + 1 AS is_middle, CAST((rank - 1 + 2) % length + 1 AS BIGINT) AS rotated_pos
FROM r""")
def q_chain_rank(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "ts")
    chain = previous(e, ["user_id"], ["ts", "event_id"], ["event_id"], prefix="next_", descending=True)
    return gr.chain_rank(chain.select(F.col("event_id").alias("node"), F.col("next_event_id").alias("next")))
