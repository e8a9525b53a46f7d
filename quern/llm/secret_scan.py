"""Secret scans over an incremental blob ledger.

A blob is a text, named by its SHA-256, so every version of a document that
ever had this text is the same blob.  The ledger has a row per scan: the blob,
the rule versions (``rule@version``) it was scanned with, and the spans found.
A scan looks only at (blob, rule version) pairs that the ledger lacks: each
new blob once, whatever the number of its copies, and an old blob only with
rules that are new or have a new version.  Findings are joined back to every
path (document) that holds the blob.

Rules are regular expressions over whole texts, matched leftmost and without
overlap per rule; matches below the rule's least length are dropped.  Spans
are in code points, end exclusive.  ``BASE`` is the contract's three rules;
``MORE`` adds spans for key blocks and prefixed tokens.

Scale: one shuffle brings equal texts together by their hash (their copies are
merged before it where they meet), and only the hashes travel back.

Defined results: a null text is an empty one; repeated rows and null ids each
get their row; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.loops import materialize
from .common import text_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int  # characters of the match, or of ``group``
    group: int = 0
    version: int = 1
    any_case: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, group=2, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),  # runs are maximal, so a shorter one cannot hold a longer one
)
MORE = (
    Rule("key_block", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0),
    Rule("prefixed", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})", 0),
)
RULES = BASE + MORE

SPAN = "struct<rule:string,kind:string,start:int,end:int>"  # rule: name and version that found it
LEDGER = f"blob string, rules array<string>, spans array<{SPAN}>"


def blobs(docs: DataFrame) -> DataFrame:
    """(blob, text): the distinct texts by their SHA-256."""
    return docs.select(text_of().alias("text")).select(F.sha2("text", 256).alias("blob"), "text").dropDuplicates(["blob"])


def unseen(found: DataFrame, rules: Sequence[Rule], ledger: DataFrame | None) -> DataFrame:
    """(blob, text, todo): the blobs with the rule versions not yet run on them."""
    names = F.array(*[F.lit(r.name) for r in rules]).cast("array<string>")
    if ledger is None:
        return found.withColumn("todo", names)
    done = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    left = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
    return found.join(done, "blob", "left").withColumn("todo", left).where(F.size("todo") > 0).drop("done")


def scan(todo: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """New ledger rows for (blob, text, todo)."""
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {r.name: (r, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0))) for r in rules}
        for b in batches:
            spans = []
            for text, names in zip(b.column("text"), b.column("todo").to_pylist()):
                t = text.as_py()
                spans.append([{"rule": r.name, "kind": r.kind, "start": m.start(), "end": m.end()}
                              for r, p in map(compiled.__getitem__, names) for m in p.finditer(t) if len(m[r.group]) >= r.least])
            kind = pa.list_(pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column("blob"), b.column("todo"), pa.array(spans, kind)], ["blob", "rules", "spans"])
    return todo.select("blob", "text", "todo").mapInArrow(run, LEDGER)


def update(docs: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """The rows to append to the ledger for the texts of ``docs``."""
    return scan(unseen(blobs(docs), rules, ledger), rules)


def findings(docs: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, spans) of every row of ``docs``: the ledger's spans of its blob,
    by start, then in the order of ``rules``.  Spans that a version found which
    is not among ``rules`` any more are left out."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    per = ledger.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    keyed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[s["rule"]].alias("rank"),
                                                    s["kind"].alias("kind"), s["end"].alias("end")))
    per = per.select("blob", F.array_sort(F.array_distinct(F.filter(keyed, lambda s: s["rank"].isNotNull()))).alias("spans"))
    per = materialize(per)  # a plain table: a blob with very many paths can then be split in the join
    return docs.select("doc_id", F.sha2(text_of(), 256).alias("blob")).join(per, "blob", "left").select("doc_id", "blob", "spans")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` with the counts and digests of its spans."""
    new = materialize(update(docs, rules, ledger))
    rows = findings(docs, new if ledger is None else ledger.unionByName(new), rules)
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")))
    base = [r.kind for r in BASE]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *[count(k) for k in base],
                       F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
                       _joined(F.col("spans")).alias("spans"))
