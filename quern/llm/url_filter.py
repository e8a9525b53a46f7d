"""URL filters: host-suffix and path-prefix expressions against hashed rules.

A URL is expanded into expressions (a suffix of its host followed by a prefix
of its path), each expression is hashed, and the first ``PREFIX_HEX`` digits
are equi-joined with the rules' own short hashes.  The full digests are
compared after the join; of the rules that fit, the longest wins (a block
before an allow of the same length).

Only suffixes and prefixes of lengths that occur among the rules are made, so
a URL yields at most (label counts x path lengths) expressions, whatever its
own length; expressions are made for distinct (host, path) pairs, so copies
of a URL are joined once.

Defined results: a null URL or one without ``://`` has an empty host and path
and no rule; with no rules every URL gets ``default``; repeated rows keep
their number; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import literal_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url_host_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL by plain cuts, no decoding."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every (host suffix of a listed number of labels) + (path prefix of a
    listed length) of one URL."""
    suffix = F.filter(F.array(*[F.when((F.size(F.split(host, r"\.")) >= n) & (host != ""),
                                       F.substring_index(host, ".", -n)) for n in labels]),
                      lambda s: s.isNotNull())
    prefix = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
                      lambda p: p.isNotNull())
    return F.array_distinct(F.flatten(F.transform(suffix, lambda s: F.transform(prefix, lambda p: F.concat(s, p)))))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id",
                url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``.

    ``rules``: (verdict, host, path); the list is a parameter, so its table is
    small, and Spark chooses the join by its size."""
    host, path = url_host_path(F.col(url_col))
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    if not rules:
        return parsed.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                             F.lit(default).alias("verdict"))
    table = (literal_table(pages.sparkSession, list(rules), [("verdict", "string"), ("rhost", "string"), ("rpath", "string")])
             .withColumn("rule", F.concat("rhost", "rpath"))
             .withColumn("digest", F.sha2("rule", 256))
             .withColumn("short", F.substring("digest", 1, PREFIX_HEX)))
    labels = sorted({r[1].count(".") + 1 for r in rules})
    lengths = sorted({len(r[2]) for r in rules})
    expanded = (parsed.select("host", "path").distinct()
                .select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), labels, lengths)).alias("expr"))
                .withColumn("digest", F.sha2("expr", 256)).drop("expr")
                .withColumn("short", F.substring("digest", 1, PREFIX_HEX)))
    r = table.select(F.col("short").alias("rshort"), F.col("digest").alias("rdigest"), "rule", "verdict")
    hits = (expanded.join(r, (F.col("short") == F.col("rshort")) & (F.col("digest") == F.col("rdigest")))
            .groupBy(F.col("host").alias("h"), F.col("path").alias("p"))
            .agg(F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"),
                                F.col("rule"), F.col("verdict"))).alias("best")))
    return (parsed.join(hits, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")))
