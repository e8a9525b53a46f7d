"""Grid and matrix operators on ``(row, col, val)`` cell tables (survey 2.11).

Re-indexing is pure projection; row/column facts are group-bys joined back;
2-D prefix sums are two skew-safe scans (along rows, then along columns)
and rectangle sums four equi-joins; neighbours are equi-joins on shifted
coordinates.  Grid sizes are scalar subqueries, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.loops import materialize
from ..plans.scan import Agg, ordered_scan
from .graph import component_sizes, connected_components, spanning_forest


def dense_cells(cells: DataFrame, rows: DataFrame, n_cols: Column) -> DataFrame:
    """Every (row, col) for the given rows and cols 0..n_cols-1, val 0 where absent."""
    spine = rows.select(F.col(rows.columns[0]).alias("row")).distinct().select(
        "row", F.explode(F.sequence(F.lit(0).cast("long"), (n_cols - 1).cast("long"))).alias("col"))
    return spine.join(cells, ["row", "col"], "left").fillna(0, ["val"])


def reindex(cells: DataFrame, k: int = 1) -> DataFrame:
    """Transpose, rotate 90 degrees clockwise, flip left-right with 0/1
    inversion, and cyclic shift by k (row-major), as new coordinates."""
    n_rows = cells.select(F.max("row") + 1).scalar()
    n_cols = cells.select(F.max("col") + 1).scalar()
    lin = (F.col("row") * n_cols + F.col("col") + k) % (n_rows * n_cols)
    return cells.select(
        "row", "col", "val",
        F.col("col").alias("t_row"), F.col("row").alias("t_col"),
        F.col("col").alias("rot_row"), (n_rows - 1 - F.col("row")).alias("rot_col"),
        (n_cols - 1 - F.col("col")).alias("flip_col"), F.when(F.col("val") == 0, 1).otherwise(0).alias("inverted"),
        F.floor(lin / n_cols).cast("long").alias("shift_row"), (lin % n_cols).cast("long").alias("shift_col"))


def zero_cross(cells: DataFrame) -> DataFrame:
    """Zero every row and every column that holds a zero."""
    zr = cells.where(F.col("val") == 0).select(F.col("row").alias("_zr")).distinct()
    zc = cells.where(F.col("val") == 0).select(F.col("col").alias("_zc")).distinct()
    j = cells.join(zr, cells["row"] == zr["_zr"], "left").join(zc, F.col("col") == zc["_zc"], "left")
    return j.select("row", "col", F.when(F.col("_zr").isNotNull() | F.col("_zc").isNotNull(), F.lit(0))
                    .otherwise(F.col("val")).cast("long").alias("val"))


def prefix_2d(cells: DataFrame) -> DataFrame:
    """P(r, c) = sum of val over rows <= r and cols <= c (dense cells)."""
    a = ordered_scan(cells.select("row", "col", "val"), ["row"], ["col"], [Agg("_rs", "sum", F.col("val"))])
    b = ordered_scan(a, ["col"], ["row"], [Agg("p", "sum", F.col("_rs"))])
    return b.select("row", "col", "p")


def region_sum(cells: DataFrame, queries: DataFrame, name: str = "region_sum") -> DataFrame:
    """Sum inside each query rectangle (r1, c1, r2, c2), by inclusion-exclusion
    over four prefix lookups (missing corners count 0)."""
    p = prefix_2d(cells)

    def at(q: DataFrame, r: Column, c: Column, alias: str) -> DataFrame:
        pp = p.select(F.col("row").alias(f"{alias}_r"), F.col("col").alias(f"{alias}_c"), F.col("p").alias(alias))
        return q.join(pp, (r == F.col(f"{alias}_r")) & (c == F.col(f"{alias}_c")), "left").drop(
            f"{alias}_r", f"{alias}_c")

    q = at(queries, F.col("r2"), F.col("c2"), "_a")
    q = at(q, F.col("r1") - 1, F.col("c2"), "_b")
    q = at(q, F.col("r2"), F.col("c1") - 1, "_c")
    q = at(q, F.col("r1") - 1, F.col("c1") - 1, "_d")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return q.select(*queries.columns, (z("_a") - z("_b") - z("_c") + z("_d")).alias(name))


def region_boundary(cells: DataFrame, q) -> DataFrame:
    """Perimeter of the cells with val > q: 4 x land - 2 x shared edges."""
    land = cells.where(F.col("val") > q).select("row", "col")
    right = land.select(F.col("row").alias("_r"), (F.col("col") - 1).alias("_c"))
    down = land.select((F.col("row") - 1).alias("_r"), F.col("col").alias("_c"))
    shared_r = land.join(right, (F.col("row") == F.col("_r")) & (F.col("col") == F.col("_c"))).agg(
        F.count(F.lit(1)).alias("n"))
    shared_d = land.join(down, (F.col("row") == F.col("_r")) & (F.col("col") == F.col("_c"))).agg(
        F.count(F.lit(1)).alias("n"))
    n_land = land.agg(F.count(F.lit(1)).alias("land"))
    sh = shared_r.unionAll(shared_d).agg(F.sum("n").alias("shared"))
    both = n_land.unionByName(sh, allowMissingColumns=True).agg(F.max("land").alias("land"), F.max("shared").alias("shared"))
    return both.select("land", "shared", (4 * F.col("land") - 2 * F.col("shared")).alias("perimeter"))


def cell_links(cells: DataFrame, same=None) -> DataFrame:
    """(src, dst) ids of neighbouring cells (right and down), a cell's id being
    the pair (row, col); ``same`` names a column in which they must agree."""
    agree = [F.lit(None).alias("_same")] if same is None else [F.col(same).alias("_same")]
    here = cells.select(F.struct("row", "col").alias("src"), F.col("row").alias("_r"), F.col("col").alias("_c"), *agree)
    out = []
    for r, c in ((0, 1), (1, 0)):
        there = cells.select(F.struct("row", "col").alias("dst"), (F.col("row") - r).alias("_r2"), (F.col("col") - c).alias("_c2"),
                             *[x.alias("_same2") for x in agree])
        on = (F.col("_r") == F.col("_r2")) & (F.col("_c") == F.col("_c2"))
        if same is not None:
            on = on & F.col("_same").eqNullSafe(F.col("_same2"))
        out.append(here.join(there, on).select("src", "dst"))
    return out[0].unionByName(out[1])


def grid_islands(cells: DataFrame, q) -> DataFrame:
    """4-neighbour islands of the cells with val > q: (island_row, island_col,
    area).  An island is named by its smallest cell."""
    land = cells.where(F.col("val") > q)
    labels = connected_components(cell_links(land), nodes=land.select(F.struct("row", "col").alias("id")))
    return component_sizes(labels).select(F.col("comp.row").alias("island_row"), F.col("comp.col").alias("island_col"),
                                         F.col("size").alias("area"))


def flooded_region(cells: DataFrame, seeds: DataFrame, val: str = "val") -> DataFrame:
    """(row, col) of the cells that a fill from any of the ``seeds`` (row, col)
    reaches over neighbours of the seed's value (null is a value).  A label join: the
    regions of equal values are components, those of the seeds stay."""
    labels = connected_components(cell_links(cells, val), nodes=cells.select(F.struct("row", "col").alias("id")))
    marked = seeds.select(F.struct("row", "col").alias("node")).join(labels, "node").select("comp").distinct()
    return labels.join(marked, "comp", "left_semi").select("node.row", "node.col")


def enclosed_cells(cells: DataFrame, q) -> DataFrame:
    """(row, col) of the cells with val <= q in regions that touch no border: not
    the first or last row or column of the table."""
    open_ = cells.where(F.col("val") <= q).select("row", "col")
    labels = connected_components(cell_links(open_), nodes=open_.select(F.struct("row", "col").alias("id")))
    edge = cells.agg(F.min("row").alias("r1"), F.max("row").alias("r2"), F.min("col").alias("c1"), F.max("col").alias("c2"))
    r, c = F.col("node.row"), F.col("node.col")
    # One row of four numbers.
    touching = (labels.join(F.broadcast(edge), r.isin(F.col("r1"), F.col("r2")) | c.isin(F.col("c1"), F.col("c2")))
                .select("comp").distinct())
    return labels.join(touching, "comp", "left_anti").select("node.row", "node.col")


def islands_after_additions(additions: DataFrame, t: str = "t") -> DataFrame:
    """(t, islands): how many islands there are after each addition of a cell
    (row, col) at a time of its own; adding a cell again changes nothing.

    Two neighbours are linked when the later one is added.  A link merges two
    islands exactly if it is in the minimum spanning forest by that time, so
    the count is a running sum of +1 for a new cell and -1 for a forest link."""
    first = materialize(additions.groupBy("row", "col").agg(F.min(t).alias("_t")))
    at = first.select(F.struct("row", "col").alias("_id"), "_t")
    links = (cell_links(first).join(at.select(F.col("_id").alias("src"), F.col("_t").alias("_ts")), "src")
             .join(at.select(F.col("_id").alias("dst"), F.col("_t").alias("_td")), "dst")
             .select("src", "dst", F.greatest("_ts", "_td").alias("w")))
    forest = spanning_forest(links)
    steps = (first.select(F.col("_t").alias("t"), F.lit(1).cast("long").alias("d"))
             .unionByName(forest.select(F.col("w").alias("t"), F.lit(-1).cast("long").alias("d")))
             .unionByName(additions.select(F.col(t).alias("t"), F.lit(0).cast("long").alias("d")))
             .groupBy("t").agg(F.sum("d").alias("d")))
    return ordered_scan(steps, [], ["t"], [Agg("islands", "sum", F.col("d"))]).select(F.col("t").alias(t), "islands")
