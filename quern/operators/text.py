"""Scalar, string and array work run as jobs (survey 2.8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The number grammar (trim, sign, digits, optional dot, digits,
# optional exponent with sign and digits).
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def word_stats(df: DataFrame, text: str, group: str) -> DataFrame:
    """Words are runs of non-space characters.  Per group: mean and max number
    of words per text, and the mean length of the last word (trailing spaces
    skipped)."""
    n = F.regexp_count(F.col(text), F.lit(r"\S+"))
    last = F.length(F.regexp_extract(F.col(text), r"(\S+)\s*$", 1))
    per = df.select(group, n.alias("_n"), last.alias("_last"))
    return per.groupBy(group).agg(F.avg("_n").alias("avg_words"), F.max("_n").alias("max_words"),
                                  F.avg("_last").alias("avg_last_word"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (other letters unchanged)."""
    return F.translate(c, UPPER, LOWER)


def defang(c: Column) -> Column:
    """Every dot bracketed: a.b -> a[.]b."""
    return F.replace(c, F.lit("."), F.lit("[.]"))


def simplify_path(path: Column) -> Column:
    """Canonical absolute path: empty and '.' segments dropped, '..' removes
    the segment before it (at the root it stays at the root)."""
    segs = F.split(path, "/")
    stack = F.aggregate(segs, F.array().cast("array<string>"), lambda acc, s: F.when(
        (s == "") | (s == "."), acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, s)))
    return F.concat(F.lit("/"), F.array_join(stack, "/"))


def url_normalise(df: DataFrame, url: str) -> DataFrame:
    """Canonical page = ASCII-lower-case host + simplified path; pages per
    canonical form, with the defanged host."""
    host = ascii_lower(F.regexp_extract(F.col(url), r"^[A-Za-z]+://([^/?#:]+)", 1))
    path = F.regexp_extract(F.col(url), r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1)
    canon = F.concat(host, simplify_path(path))
    return (df.select(canon.alias("canonical"), defang(host).alias("host_defanged"))
            .groupBy("canonical", "host_defanged").agg(F.count(F.lit(1)).alias("n_pages")))


def version_key(v: Column, width: int = 4) -> Column:
    """Dotted version as an int array padded with zeros to ``width`` parts."""
    parts = F.transform(F.split(v, r"\."), lambda x: x.cast("int"))
    return F.concat(parts, F.array_repeat(F.lit(0), F.greatest(F.lit(width) - F.size(parts), F.lit(0))))


def version_max(df: DataFrame, key: str, version: str, width: int = 4) -> DataFrame:
    """Highest version per key by numeric parts (missing parts are 0)."""
    return df.groupBy(key).agg(F.max_by(version, version_key(F.col(version), width)).alias("max_version"))


def _tokens(df: DataFrame, text: str, group: str) -> DataFrame:
    return df.select(group, F.explode(F.split(F.trim(F.col(text)), r"\s+")).alias("_t")).where(F.col("_t") != "")


def numeric_audit(df: DataFrame, text: str, group: str) -> DataFrame:
    """Per group: tokens (non-space runs) and how many parse as a number by
    the grammar; :func:`numeric_rejects` lists the others."""
    tok = _tokens(df, text, group)
    ok = F.col("_t").rlike(NUMBER)
    return tok.groupBy(group).agg(F.count(F.lit(1)).alias("n_tokens"),
                                  F.sum(F.when(ok, 1).otherwise(0)).cast("long").alias("n_numeric"))


def numeric_rejects(df: DataFrame, text: str, group: str) -> DataFrame:
    """Tokens with a digit that are no number by the grammar: (group, token,
    n).  A null text has no tokens; a null group is a group."""
    bad = _tokens(df, text, group).where(F.col("_t").rlike("[0-9]") & ~F.col("_t").rlike(NUMBER))
    return bad.groupBy(group, F.col("_t").alias("token")).agg(F.count(F.lit(1)).alias("n"))


def leading_integer(c: Column) -> Column:
    """atoi: optional spaces, sign, digits; clamped to 32-bit; 0 when absent."""
    m = F.regexp_extract(c, r"^\s*([+-]?[0-9]+)", 1)
    big = F.when(m == "", None).otherwise(F.regexp_replace(m, r"^([+-]?)0+(?=[0-9])", "$1"))
    v = big.try_cast("decimal(38,0)")
    clamp = F.when(v.isNull() & (m != ""), F.when(m.startswith("-"), F.lit(-2147483648)).otherwise(F.lit(2147483647))) \
        .when(v > 2147483647, F.lit(2147483647)).when(v < -2147483648, F.lit(-2147483648)).otherwise(v)
    return F.coalesce(clamp.cast("long"), F.lit(0).cast("long"))
