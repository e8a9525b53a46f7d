"""Span and box joins with sides of very mixed sizes: brute force, and the
rows made of one long span or box among short ones."""

import itertools
import random

from pyspark.sql import functions as F

from quern.operators import joins as jn


def test_mixed_spans_nulls_and_empty_spans(spark):
    rng = random.Random(4)
    def side(first):
        out = []
        for i in range(60):
            s = rng.randint(-3000, 3000)
            out.append((rng.choice([0, 1, None]), first + i, s, s + rng.choice([0, 1, 2, 3, 64, 65, 900, 5000])))
        return out + [(0, first + 60, None, 5), (0, first + 61, 9, None), (0, first + 62, 9, 8)]
    a, b = side(0), side(100)
    da = spark.createDataFrame(a, "k long, a_id long, st long, en long")
    db = spark.createDataFrame(b, "k long, b_id long, st long, en long")
    got = sorted((str(r.k), r.a_id, r.b_id, r.overlap) for r in jn.interval_overlap_join(da, db, ["k"], "a_id", "b_id").collect())
    full = lambda rows: [r for r in rows if None not in r[2:] and r[2] <= r[3]]
    exp = sorted((str(k), i, j, min(e, f) - max(s, t) + 1) for k, i, s, e in full(a) for m, j, t, f in full(b)
                 if k == m and max(s, t) <= min(e, f))
    assert got == exp


def test_mixed_boxes(spark):
    rng = random.Random(5)
    boxes = []
    for i in range(70):
        x, y = rng.randint(-200, 200), rng.randint(-200, 200)
        boxes.append((i, x, y, x + rng.choice([0, 1, 2, 7, 300]), y + rng.choice([1, 3, 16, 250])))
    df = spark.createDataFrame(boxes, "id long, x1 long, y1 long, x2 long, y2 long")
    got = sorted((r.id_a, r.id_b, r.overlap_area) for r in jn.box_overlap_join(df, "id", "x1", "y1", "x2", "y2").collect())
    exp = []
    for (i, *a), (j, *b) in itertools.combinations(boxes, 2):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        if w > 0 and h > 0:
            exp.append((i, j, w * h))
    assert got == sorted(exp)


def test_one_long_span_makes_no_explosion(spark):
    """A span of 2^40 days beside 2,000 short ones, and a box as wide: fixed
    buckets of 64 would make 17 thousand million rows of it."""
    short = spark.range(2000).select(F.col("id").alias("a_id"), (F.col("id") * 10).alias("st"), (F.col("id") * 10 + 3).alias("en"))
    both = short.unionByName(spark.range(1).selectExpr("-1L AS a_id", "0L AS st", "1L << 40 AS en"))
    got = jn.interval_overlap_join(both, both.withColumnRenamed("a_id", "b_id"), [], "a_id", "b_id")
    assert got.count() == 2000 + 1 + 2 * 2000
    boxes = both.selectExpr("a_id AS id", "st AS x1", "0L AS y1", "en AS x2", "CASE WHEN a_id < 0 THEN 1L << 40 ELSE 5L END AS y2")
    assert jn.box_overlap_join(boxes, "id", "x1", "y1", "x2", "y2").count() == 2000
