"""Column expressions and table helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Word separators: space and the control characters 09 to 0D.
WS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"
# str.translate table that lowers A-Z and nothing else.
LOWER = {c: c + 32 for c in range(65, 91)}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the
    body (or a lambda inside it) uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def words(text: Column) -> Column:
    """Words as an array; null and blank texts have none."""
    trimmed = F.btrim(text, F.lit(WS))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(trimmed, F.lit("")) == "", none).otherwise(F.split(trimmed, WS_RUN))


def literal_table(spark: SparkSession, rows: list[tuple], schema: list[tuple[str, str]]) -> DataFrame:
    """A parameter (a short list of rows) as a table, without Python workers."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in schema])
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, schema)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], limit: int = 100_000) -> DataFrame:
    """Inner join of ``big`` with ``small`` (one or few rows per key, no null
    keys).  A key with more than ``limit`` rows of ``big``, and more than a
    thousandth of them, is dealt to as many parts as its rows ask for and its rows of
    ``small`` are repeated for each: fewer than a thousand keys, a bounded table."""
    per = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, most = per.agg(F.sum("_n"), F.max("_n")).first()
    bound = max(limit, (total or 0) // 1000)
    if (most or 0) <= bound:
        return big.join(small, keys)
    hot = F.broadcast(per.where(F.col("_n") > bound).select(*keys, F.ceil(F.col("_n") / bound).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = big.join(hot, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*big.columns), parts).cast("int")).drop("_parts")
    copies = small.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copies, [*keys, "_part"]).drop("_part")
