import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import contamination as cn
from llm_fixtures import edge_docs, empty_docs, multiset

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def slow(docs, items, window=10):
    wins = {}
    for item, text in items:
        ws = words(text)
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1) if n else ():
            wins.setdefault(tuple(ws[i:i + n]), set()).add(item)
    sizes = sorted({len(w) for w in wins})
    out = []
    for i, text in docs:
        ws = words(text)
        hit, held = set(), set()
        for n in sizes:
            for p in range(len(ws) - n + 1):
                for item in wins.get(tuple(ws[p:p + n]), ()):
                    hit.update(range(p, p + n))
                    held.add(item)
                if tuple(ws[p:p + n]) in wins:
                    hit.update(range(p, p + n))
        held = sorted(str(x) for x in held if x is not None)
        out.append((i, len(ws), len(hit), len(held), hashlib.sha256(",".join(held).encode()).hexdigest(), bool(hit)))
    return multiset(out)


def tables(seed=4):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(25)] + ["É", "日本", "x1"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.randint(0, 35))) for i in range(60)] + [(60, "w1"), (61, "w2 w3"), (62, "W4, w5! w6"), (62, say(14)), (None, say(12)),
             (70, None), (71, ""), (72, "same words " * 8), (73, "same words " * 8)]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(say(rng.randint(0, 30)).replace("w1 ", "v ").replace("w2 w3", "w2 v"))
            if rng.random() < 0.5:
                t = (rng.choice(items)[1] or "").split()
                a = rng.randint(0, len(t))
                parts.append(" ".join(t[a:a + rng.choice([5, 9, 10, 11, 40])]))
        docs.append((i, rng.choice([" ", "\n", ". "]).join(parts).upper() if i % 5 == 0 else "; ".join(parts)))
    docs += docs[:5] + [(None, items[3][1]), (None, None), (7, ""), (8, "same words " * 30_000)]
    return docs, items


@pytest.mark.parametrize("window", [10, 4, 13])
def test_matches_brute_force(spark, window):
    docs, items = tables()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"rid": F.lit("x"), "runs": F.lit(1), "phrase": F.lit(2), "start": F.lit(3)})
    b = spark.createDataFrame(items, "item_id long, text string").withColumns({"length": F.lit("x"), "item": F.lit(1)})
    out = cn.contamination(d, b, window)
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = slow(docs, items, window)
    assert multiset(out.collect()) == want and 20 < sum(r[5] for r in want)


def test_all_slots_set_changes_nothing(spark, monkeypatch):
    """Every shingle on a slot of the benchmark: whole texts are runs."""
    docs, items = tables(9)
    monkeypatch.setattr(cn, "_slot_bits", lambda shingles: b"\xff" * (1 << (cn.SLOT_BITS - 3)))
    d, b = spark.createDataFrame(docs[:60], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert multiset(cn.contamination(d, b).collect()) == slow(docs[:60], items)


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(1, rows[0][1]), (2, "a b c d e f a b c d"), (3, "two"), (None, "one")]
    b = spark.createDataFrame(items, "item_id long, text string")
    assert multiset(cn.contamination(docs, b).collect()) == slow(rows, items)
    assert cn.contamination(empty_docs(spark), b).collect() == []
    none = cn.contamination(docs, b.where("item_id = 9"))
    assert multiset(none.collect()) == slow(rows, [])
