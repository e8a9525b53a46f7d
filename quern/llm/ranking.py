"""Ranks of rows inside their key, however many rows one key holds.

Rows are range-partitioned by the whole tuple (key, order), so a key of any
size is spread over as many partitions as its rows need.  Rows per (key,
partition) are counted; the running sum of those counts is the rank at which
a partition starts, and one window per (key, partition) adds the place inside
it.  No task gets more than one range of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.loops import materialize

ROWS_PER_RANGE = 500_000


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str, per_key: DataFrame | None = None) -> DataFrame:
    """Add ``name``: 1-based place of the row inside ``keys`` (null is a key of
    its own) by ``order``.  ``df`` should be narrow: it is written once.

    ``per_key`` (the keys, one row each, with more columns) is added too, by
    way of the counts per (key, partition), so a large key's rows never meet
    in a join on the key alone."""
    spark = df.sparkSession
    df = materialize(df)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_RANGE))
    ranged = materialize(df.repartitionByRange(parts, *[F.col(k) for k in keys], *order)
                         .withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    more = []
    if per_key is not None:
        more = [c for c in per_key.columns if c not in keys]
        on = F.lit(True)
        for i, k in enumerate(keys):
            on = on & F.col(f"_k{i}").eqNullSafe(F.col(f"_p{i}"))
        starts = starts.join(per_key.select(*more, *[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)]), on)
    here = Window.partitionBy(*keys, "_range").orderBy(*order)
    local = ranged.withColumn("_place", F.row_number().over(here))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (local.join(starts, same)
            .select(*df.columns, *more, (F.col("_start") + F.col("_place")).cast("long").alias(name)))
