import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import spelling as sp
from llm_fixtures import edge_docs, empty_docs, multiset


def slow_words(rows, min_len=7, min_count=2, noise=31):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_len and n >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def slow(rows, ratio=10, **kw):
    words = slow_words(rows, **kw)
    form = {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return multiset((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def corpus(seed=3, docs=250):
    rng = random.Random(seed)
    parts = ["an", "ber", "tion", "è", "ing", "ÿa", "ro", "st", "the", "×", "ed"]
    base = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 6))) for _ in range(60)]

    def word():
        w = base[min(int(rng.expovariate(0.12)), len(base) - 1)]
        if rng.random() < 0.15 and w:
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("aeèt") + w[i:], w[:i] + rng.choice("aeèt") + w[i + 1:]])
        return w.upper() if rng.random() < 0.1 else w
    rows = [(i if i % 17 else None, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(docs)]
    return rows + [(1, None), (2, ""), (3, "x" * 20_000 + " " + "x" * 20_000), (4, "x" * 19_999 + " " + "x" * 19_999)] + rows[:20]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_matches_brute_force(spark, rows):
    docs = frame(spark, rows).withColumns({"word": F.lit(1), "n": F.lit("x"), "form": F.lit(None).cast("int"), "key": F.lit(2)})
    out = sp.variants(docs)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = multiset(out.collect())
    assert got == slow(rows)
    assert sum(r[1] is not None for r in got) > 50 and any(r[2] not in (r[0], r[1]) for r in got)


@pytest.mark.parametrize("frequent", [0, 2, 6])
def test_no_pair_is_lost_at_any_pruning(spark, rows, frequent):
    words = slow_words(rows, min_count=1)
    df = spark.createDataFrame([(w, n) for w, n in words.items() if len(w) < 100], "word string, n long")
    keep = [w for w in words if len(w) < 100]
    want = {(a, b) for a in keep for b in keep if one_edit(a, b) and (len(a), a) < (len(b), b)}
    got = {tuple(r) for r in sp.near_pairs(df, 7, frequent).collect()}
    assert got == want and len(want) > 300


def test_lists_stay_short(spark):
    """Words of few parts: what the lists bring together grows with the words."""
    rng = random.Random(1)
    words = sorted({"".join(rng.choice(["an", "be", "ti", "ro", "st", "ed"]) for _ in range(5)) for _ in range(6000)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    entries = sp.lists(df, sp.gram_dictionary(df))
    met = entries.groupBy("key").agg(F.count("word").alias("x"), F.count(F.when(~F.col("longer"), 1)).alias("y"))
    assert met.agg(F.sum(F.col("x") * F.col("y"))).first()[0] < 100 * len(words)
    assert met.agg(F.max("x")).first()[0] <= 1 << (sp.FREQUENT + 1)


def test_edges(spark):
    docs = edge_docs(spark)
    assert multiset(sp.variants(docs).collect()) == slow([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sp.variants(empty_docs(spark)).collect() == []
    tie = [(i, t) for i, t in enumerate(["abcdefg " * 40 + "abcdefh " * 40 + "abcdefx " * 2])]
    got = {r.word: r for r in sp.variants(frame(spark, tie), noise=0).collect()}
    assert got["abcdefx"].form == "abcdefg" and got["abcdefx"].n_near == 2 and got["abcdefg"].form is None
