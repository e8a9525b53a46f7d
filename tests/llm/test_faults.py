"""Cases that earlier versions of the operators got wrong."""
import random
from dataclasses import replace

from pyspark.sql import functions as F

from quern.llm import line_dedup, mixing, quality_gam, secret_scan as ss, simhash
from llm_fixtures import docs_of, multiset

CLASH = ["_first", "_c", "_m", "_t", "_gone", "_gd", "_gt", "row", "id", "th", "fp", "kept_id", "of", "gone", "i", "s", "z", "x", "comp"]


def clashing(docs):
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def test_a_bad_tail_counts():
    good = " ".join(f"word{i}" for i in range(200))
    at = quality_gam.FEATURES.index("worst_symbols")
    for n in (1, 50, 99, 100, 150):
        f = quality_gam.features(good + " buy##!" * n)
        assert f[at] > 0 and f[quality_gam.FEATURES.index("worst_distinct")] <= (201 - n + 1) / 200 + 0.01


def test_stricter_rule_version(spark):
    docs = docs_of(spark, ["key " + "0123456789abcdef" * 2, "key " + "0123456789abcdef" * 3])
    first = ss.update(docs)
    newer = [replace(r, version=2, least=40) if r.kind == "hex" else r for r in ss.RULES]
    got = {r.doc_id: r.n_hex for r in ss.secrets(docs, newer, first).collect()}
    assert got == {0: 0, 1: 1}


def test_keep_one_tells_equal_ids_apart(spark):
    rng = random.Random(3)
    a, b, c = (" ".join(rng.choice("abcdefghij") * 3 + str(rng.random()) for _ in range(80)) for _ in range(3))
    rows = [(5, a), (5, b), (None, c), (None, c), (None, a), (7, a), (7, a), (9, None), (8, "")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert multiset(kept.select("doc_id", "text").collect()) == multiset([(5, a), (5, b), (None, c), (8, "")])
    assert kept.where("_first = 'own _first' AND comp = 'own comp'").count() == 4


def test_clashing_names(spark):
    rng = random.Random(4)
    line = " ".join(f"w{i}" for i in range(60))
    texts = [line + f"\nx{i} " + " ".join(rng.choice("abc") for _ in range(9)) for i in range(6)]
    plain = docs_of(spark, texts)
    docs = clashing(plain)
    out = line_dedup.dedup_lines(docs, info=None)
    assert out.columns == docs.columns
    want = line_dedup.dedup_lines(plain).select("doc_id", "text").collect()
    assert multiset(out.select("doc_id", "text").collect()) == multiset(want) and any(r.text not in texts for r in want)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.where("_c <> 'own _c' OR i <> 'own i'").count() == 0
    assert multiset(mixed.select(plain.columns).collect()) == multiset(mixing.mixed_documents(plain).collect())
