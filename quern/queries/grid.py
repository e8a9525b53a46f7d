"""Grid operators bound to the driver tables (survey 2.11).

Matrix M: row = user, col = event type (the table's types in text order),
val = number of events.  Grid G: row = user, col = day of month - 1, val = events that day.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as gd
from ..sources.tables import table
from ..plans.scan import row_index
from .registry import query

_M_SQL = """
ty AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS col FROM (SELECT DISTINCT event_type FROM events)),
c AS (SELECT user_id AS row, ty.col, count(*) AS n FROM events JOIN ty USING (event_type) GROUP BY 1, 2),
m AS (SELECT u.row, t.col, coalesce(c.n, 0) AS val FROM (SELECT DISTINCT user_id AS row FROM events) u
      CROSS JOIN (SELECT col FROM ty) t LEFT JOIN c ON c.row = u.row AND c.col = t.col)"""


def _matrix(spark, d):
    e = table(spark, d, "events")
    types = row_index(e.select("event_type").distinct(), [], ["event_type"], name="n")
    c = (e.join(types, "event_type").groupBy(F.col("user_id").alias("row"), (F.col("n") - 1).cast("long").alias("col"))
         .agg(F.count(F.lit(1)).alias("val")))
    return gd.dense_cells(c, e.select("user_id"), types.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar())


_G_SQL = """
g AS (SELECT user_id AS row, CAST(dayofmonth(ts) - 1 AS BIGINT) AS col, count(*) AS val FROM events GROUP BY 1, 2)"""


def _grid(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.col("user_id").alias("row"), (F.dayofmonth("ts") - 1).cast("long").alias("col")).agg(
        F.count(F.lit(1)).alias("val"))


@query("grid_transform", f"""
WITH {_M_SQL},
s AS (SELECT max(row) + 1 AS nr, max(col) + 1 AS nc FROM m)
SELECT row, col, val, col AS t_row, row AS t_col, col AS rot_row, nr - 1 - row AS rot_col, nc - 1 - col AS flip_col,
       CASE WHEN val = 0 THEN 1 ELSE 0 END AS inverted,
       CAST(((row * nc + col + 7) % (nr * nc)) // nc AS BIGINT) AS shift_row,
       CAST((row * nc + col + 7) % (nr * nc) % nc AS BIGINT) AS shift_col
FROM m, s""")
def q_grid_transform(spark, d):
    return gd.reindex(_matrix(spark, d), 7)


@query("zero_cross", f"""
WITH {_M_SQL}
SELECT row, col, CAST(CASE WHEN row IN (SELECT row FROM m WHERE val = 0) OR col IN (SELECT col FROM m WHERE val = 0)
                       THEN 0 ELSE val END AS BIGINT) AS val FROM m""")
def q_zero_cross(spark, d):
    return gd.zero_cross(_matrix(spark, d))


@query("region_sum", f"""
WITH {_M_SQL},
q AS (SELECT u AS r1, CAST(1 AS BIGINT) AS c1, least(u + 9, (SELECT max(row) FROM m)) AS r2, CAST(3 AS BIGINT) AS c2
      FROM (SELECT DISTINCT user_id AS u FROM events))
SELECT q.r1, q.c1, q.r2, q.c2, CAST(coalesce(sum(m.val), 0) AS BIGINT) AS region_sum
FROM q LEFT JOIN m ON m.row BETWEEN q.r1 AND q.r2 AND m.col BETWEEN q.c1 AND q.c2 GROUP BY 1, 2, 3, 4""")
def q_region_sum(spark, d):
    m = _matrix(spark, d)
    top = m.select(F.max("row")).scalar()
    qs = table(spark, d, "events").select(F.col("user_id").alias("r1")).distinct().select(
        "r1", F.lit(1).cast("long").alias("c1"), F.least(F.col("r1") + 9, top).alias("r2"),
        F.lit(3).cast("long").alias("c2"))
    return gd.region_sum(m, qs).withColumn("region_sum", F.col("region_sum").cast("long"))


@query("region_boundary", f"""
WITH {_G_SQL},
land AS (SELECT row, col FROM g WHERE val > 2),
sh AS (SELECT (SELECT count(*) FROM land a JOIN land b ON b.row = a.row AND b.col = a.col + 1)
            + (SELECT count(*) FROM land a JOIN land b ON b.row = a.row + 1 AND b.col = a.col) AS shared)
SELECT (SELECT count(*) FROM land) AS land, shared, 4 * (SELECT count(*) FROM land) - 2 * shared AS perimeter FROM sh""")
def q_region_boundary(spark, d):
    return gd.region_boundary(_grid(spark, d), 2)


@query("grid_islands", f"""
WITH RECURSIVE {_G_SQL},
land AS (SELECT row * 1048576 + col AS id, row, col FROM g WHERE val > 2),
e AS (SELECT a.id AS u, b.id AS v FROM land a JOIN land b ON (b.row = a.row AND b.col = a.col + 1)
                                                       OR (b.row = a.row + 1 AND b.col = a.col)),
und AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
cc(node, comp) USING KEY (node) AS (
  SELECT id, id FROM land
  UNION
  SELECT n.node, n.m FROM (SELECT x.v AS node, min(c.comp) AS m FROM cc c JOIN und x ON x.u = c.node GROUP BY x.v) n
  JOIN recurring.cc r ON r.node = n.node WHERE n.m < r.comp)
SELECT comp AS island, count(*) AS area FROM cc GROUP BY comp""")
def q_grid_islands(spark, d):
    i = gd.grid_islands(_grid(spark, d), 2)
    return i.select((F.col("island_row") * 1048576 + F.col("island_col")).alias("island"), "area")


@query("flooded_region", f"""
WITH RECURSIVE {_G_SQL},
k AS (SELECT row, col, least(val, 2) AS v FROM g),
seed AS (SELECT row, col, v FROM k WHERE col = 0),
reach(row, col, v) AS (
  SELECT row, col, v FROM seed
  UNION
  SELECT k.row, k.col, k.v FROM reach r JOIN k ON k.v = r.v AND abs(k.row - r.row) + abs(k.col - r.col) = 1)
SELECT row, col FROM reach""")
def q_flooded_region(spark, d):
    g = _grid(spark, d).withColumn("val", F.least("val", F.lit(2)))
    return gd.flooded_region(g, g.where("col = 0").select("row", "col"))


@query("enclosed_cells", f"""
WITH RECURSIVE {_G_SQL},
o AS (SELECT row, col FROM g WHERE val <= 1),
b AS (SELECT min(row) AS r1, max(row) AS r2, min(col) AS c1, max(col) AS c2 FROM g),
reach(row, col) AS (
  SELECT row, col FROM o, b WHERE row IN (r1, r2) OR col IN (c1, c2)
  UNION
  SELECT o.row, o.col FROM reach r JOIN o ON abs(o.row - r.row) + abs(o.col - r.col) = 1)
SELECT row, col FROM o WHERE (row, col) NOT IN (SELECT row, col FROM reach)""")
def q_enclosed_cells(spark, d):
    return gd.enclosed_cells(_grid(spark, d), 1)


@query("islands_after_additions")
def q_islands_after_additions(spark, d):
    e = table(spark, d, "events")
    return gd.islands_after_additions(e.select(F.col("user_id").alias("row"), (F.dayofmonth("ts") - 1).cast("long").alias("col"),
                                               F.col("event_id").alias("t")))
