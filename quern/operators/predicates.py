"""Projections, filters and predicates (survey 2.2)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import proper_case as _proper
from ..plans.scan import Agg, ordered_scan, row_index

# The ordered modulo rules of the label rule (first match wins).
FIZZ_BUZZ = [(15, "FizzBuzz"), (5, "Buzz"), (3, "Fizz")]


def proper_case(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Title-case the given columns the way Python's ``str.title`` does."""
    return df.select(*[(_proper(c).alias(c) if c in cols else F.col(c)) for c in df.columns])


def drop_values(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose value is not in ``values`` (a literal list or a table)."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(col)), col, "left_anti")
    return df.where(~F.col(col).isin(list(values)) | F.col(col).isNull())


def rule_label(df: DataFrame, col: str, rules=FIZZ_BUZZ, name: str = "label") -> DataFrame:
    """First rule whose modulus divides the value gives the label, else the
    number as text (one chained CASE, built from the rule list)."""
    expr = None
    for m, label in rules:
        cond = F.col(col) % m == 0
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(name, expr.otherwise(F.col(col).cast("string")))


def first_last_span(df: DataFrame, keys: Sequence[str], val: str, target) -> DataFrame:
    """First and last 0-based position of ``target`` in each key's sorted
    values, (-1, -1) when absent: counts of smaller and not-larger values."""
    t = F.lit(target)
    g = df.groupBy(*keys).agg(F.sum(F.when(F.col(val) < t, 1).otherwise(0)).alias("_lt"),
                              F.sum(F.when(F.col(val) == t, 1).otherwise(0)).alias("_eq"))
    hit = F.col("_eq") > 0
    return g.select(*keys, F.when(hit, F.col("_lt")).otherwise(-1).cast("long").alias("first_pos"),
                    F.when(hit, F.col("_lt") + F.col("_eq") - 1).otherwise(-1).cast("long").alias("last_pos"))


def insert_rank(values: DataFrame, probes: DataFrame, key: str, val: str, probe: str,
                name: str = "insert_pos") -> DataFrame:
    """Per probe row: the number of values of its key smaller than the probe
    (the insert position in the key's sorted values)."""
    per = values.groupBy(F.col(key).alias("_k"), F.col(val).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    v = per.where(F.col("_v").isNotNull()).select("_k", "_v", F.lit(1).alias("_kind"), "_n")
    rows = F.struct(*[F.col(c) for c in probes.columns])
    p = probes.select(F.col(key).alias("_k"), F.col(probe).alias("_v"), F.lit(0).alias("_kind"), rows.alias("_row"))
    # at equal value the probe comes first, so only smaller values are counted
    s = ordered_scan(v.unionByName(p, allowMissingColumns=True), ["_k"], ["_v", "_kind"], [Agg("_less", "sum", F.col("_n"))])
    return s.where(F.col("_kind") == 0).select("_row.*", F.coalesce("_less", F.lit(0)).cast("long").alias(name))


def fixed_points(df: DataFrame, keys: Sequence[str], val: str, order: Sequence[str]) -> DataFrame:
    """Rows whose value equals their 0-based position in the key's sorted order."""
    r = row_index(df, keys, [val, *order], name="_rn")
    return r.where(F.col(val) == F.col("_rn") - 1).withColumn("pos", F.col("_rn") - 1).drop("_rn")


def first_true(df: DataFrame, keys: Sequence[str], order: Sequence[str], cond: Column, ret: str) -> DataFrame:
    """Per key, ``ret`` of the first row in order where cond holds."""
    return df.where(cond).groupBy(*keys).agg(F.min_by(ret, F.struct(*order)).alias(ret))
