import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.plans.scan import Agg, ordered_scan, previous, row_index


def _data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        k = 0 if i % 3 else rnd.randint(1, 40)  # key 0 holds two thirds
        rows.append((k, rnd.randint(0, 100000) * 3000 + i, rnd.choice([None, rnd.randint(-50, 50)])))
    return spark.createDataFrame(rows, "k long, pos long, v long")


@pytest.mark.parametrize("chunk_rows", [50, 10_000])
@pytest.mark.parametrize("desc", [False, True])
def test_scan_matches_window(spark, chunk_rows, desc):
    df = _data(spark)
    got = ordered_scan(df, ["k"], ["pos"], [
        Agg("s", "sum", F.col("v")), Agg("c", "count", F.col("v")),
        Agg("mn", "min", F.col("v")), Agg("mx", "max", F.col("v")),
        Agg("l", "last", F.col("v")), Agg("f", "first", F.col("v")),
        Agg("sx", "sum", F.col("v"), exclusive=True),
        Agg("lx", "last", F.col("v"), exclusive=True),
    ], descending=desc, chunk_rows=chunk_rows)
    w = Window.partitionBy("k").orderBy(F.col("pos").desc() if desc else F.col("pos"))
    wi = w.rowsBetween(Window.unboundedPreceding, 0)
    wx = w.rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("*", F.sum("v").over(wi).alias("s"), F.count("v").over(wi).alias("c"),
                    F.min("v").over(wi).alias("mn"), F.max("v").over(wi).alias("mx"),
                    F.last("v", True).over(wi).alias("l"), F.first("v", True).over(wi).alias("f"),
                    F.sum("v").over(wx).alias("sx"), F.last("v", True).over(wx).alias("lx"))
    cols = ["k", "pos", "v", "s", "c", "mn", "mx", "l", "f", "sx", "lx"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())


def test_previous_and_row_index(spark):
    df = _data(spark)
    got = previous(row_index(df, ["k"], ["pos"], chunk_rows=64), ["k"], ["pos"], ["v"], chunk_rows=64)
    w = Window.partitionBy("k").orderBy("pos")
    exp = df.select("*", F.row_number().over(w).alias("rn"), F.lag("v").over(w).alias("prev_v"))
    cols = ["k", "pos", "v", "rn", "prev_v"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())


def test_unkeyed_and_timestamps(spark):
    df = _data(spark).withColumn("ts", F.timestamp_seconds("pos"))
    got = ordered_scan(df, [], ["ts"], [Agg("s", "sum", F.col("v"))], chunk_rows=100)
    exp = df.select("*", F.sum("v").over(Window.orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    assert sorted(got.select("pos", "s").collect()) == sorted(exp.select("pos", "s").collect())


def test_hot_key_is_split(spark):
    """The window of the hot key must not run as one group."""
    df = _data(spark)
    got = ordered_scan(df, ["k"], ["pos"], [Agg("s", "sum", F.col("v"))], chunk_rows=50)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_scan_chunk" in plan


def test_bursty_hot_key(spark):
    """90% of the hot key's rows sit in 1% of its value range: fine bins give
    equal-count chunks; results equal the plain window."""
    rnd = random.Random(11)
    rows = [(0, (rnd.randint(0, 999) if rnd.random() < 0.9 else rnd.randint(0, 100000)) * 1000 + i, rnd.randint(-9, 9))
            for i in range(2000)] + [(k, i, 1) for k in range(1, 5) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, pos long, v long")
    for desc in (False, True):
        got = ordered_scan(df, ["k"], ["pos"], [Agg("s", "sum", F.col("v")), Agg("mx", "max", F.col("v"))],
                           descending=desc, chunk_rows=100)
        w = Window.partitionBy("k").orderBy(F.col("pos").desc() if desc else F.col("pos")) \
            .rowsBetween(Window.unboundedPreceding, 0)
        exp = df.select("*", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("mx"))
        assert sorted(got.collect()) == sorted(exp.collect())


def _hot(spark, kind):
    """20,000 rows of one key (and a few of others) in an order that values
    alone do not split: one value, one outlier, text, null."""
    from pyspark.sql import functions as F
    o = {"constant": F.lit(7), "outlier": F.when(F.col("id") == 0, F.lit(253402214400)).otherwise(F.col("id")),
         "text": F.concat(F.lit("same long prefix "), F.format_string("%06d", (F.col("id") * 7919 % 20000).cast("int"))),
         "null": F.lit(None).cast("long")}[kind]
    return spark.range(20_000).select(F.when(F.col("id") % 100 == 5, F.col("id") % 7).cast("long").alias("k"), o.alias("o"), "id",
                                      (F.col("id") % 13).alias("v"))


@pytest.mark.parametrize("kind", ["constant", "outlier", "text", "null"])
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("desc", [False, True])
def test_hot_keys_split_by_rank_of_the_whole_order(spark, monkeypatch, kind, keyed, desc):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quern.plans import scan
    written = []
    keep = scan.materialize
    monkeypatch.setattr(scan, "materialize", lambda d: (written.append(keep(d)), written[-1])[1])
    df = _hot(spark, kind)
    keys = ["k"] if keyed else []
    got = scan.ordered_scan(df, keys, ["o", "id"], [scan.Agg("s", "sum", F.col("v")), scan.Agg("p", "last", F.col("id"), exclusive=True)],
                            descending=desc, chunk_rows=1000)
    by = [F.col(c).desc() if desc else F.col(c) for c in ("o", "id")]
    w = Window.partitionBy(*keys).orderBy(*by)
    want = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.lag("id").over(w).alias("p"))
    assert sorted(map(tuple, got.select("id", "s", "p").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    ranged = next(d for d in written if scan._CH in d.columns)
    assert ranged.groupBy(scan._CH).count().agg(F.max("count")).first()[0] <= 2000
    assert ranged.select(scan._CH).distinct().count() >= 15


def test_rows_whose_order_is_wholly_tied_still_split(spark, monkeypatch):
    from pyspark.sql import functions as F

    from quern.plans import scan
    written = []
    keep = scan.materialize
    monkeypatch.setattr(scan, "materialize", lambda d: (written.append(keep(d)), written[-1])[1])
    got = scan.row_index(_hot(spark, "constant"), [], ["o"], chunk_rows=1000)
    assert sorted(r.rn for r in got.select("rn").collect()) == list(range(1, 20_001))
    ranged = next(d for d in written if scan._CH in d.columns)
    assert ranged.groupBy(scan._CH).count().agg(F.max("count")).first()[0] <= 2000
