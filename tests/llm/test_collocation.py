import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import collocation as co
from quern.llm.common import spread_join
from llm_fixtures import edge_docs, empty_docs, multiset

LOWER = {c: c + 32 for c in range(65, 91)}


def slow(rows, max_words=3, min_count=10, cover=50, top=2000):
    f = defaultdict(Counter)
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            ws = re.findall("[^ \t]+", piece)
            total[lang] += len(ws)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in cand.items():
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= cover * a for b in longer):
                continue
            s, k = min((10 ** 6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, le, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, total[lang], -s))
    return multiset(out)


def corpus(seed=2, docs=150):
    rng = random.Random(seed)
    vocab = [f"W{i}" for i in range(40)] + ["É", "é", "\x00", "\x85", "日本"]

    def text():
        out = []
        for _ in range(rng.randint(0, 40)):
            out.append(rng.choice(["new york city", "New York", "in the end", "aa aa aa aa", rng.choice(vocab), rng.choice(vocab)]))
            out.append(rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]))
        return "".join(out)
    rows = [(i, text(), rng.choice(["en", "en", "de", None, "und"])) for i in range(docs)]
    return rows + rows[:10] + [(None, "new york " * 20_000, "en"), (None, None, "en"), (5, "", "fr"), (6, "one two", "it")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


@pytest.mark.parametrize("kw", [{"max_words": 4, "min_count": 3, "shards": 2, "top": 30}])
def test_matches_brute_force(spark, rows, kw):
    docs = frame(spark, rows).withColumns({"phrase": F.lit(1), "n": F.lit("x"), "k": F.lit(None).cast("int"), "shard": F.lit("s")})
    out = co.collocations(docs, **kw)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = slow([(la, t) for _, t, la in rows], **{k: v for k, v in kw.items() if k != "shards"})
    assert multiset(out.collect()) == want and len(want) > 5


def test_shared_slots_change_nothing(spark, rows, monkeypatch):
    """All phrases on few slots: more is activated, the result is the same."""
    real = co.Reached.has
    monkeypatch.setattr(co, "SHARDS", 2)
    all_set = co.Reached(b"\xff" * (1 << (co.SLOT_BITS - 3)))
    assert real(all_set, co.np.arange(5, dtype="uint64")).all()
    monkeypatch.setattr(co.Reached, "with_slots", lambda self, slots: all_set if len(slots) else self)
    got = co.collocations(frame(spark, rows[:60]), shards=2)
    assert multiset(got.collect()) == slow([(la, t) for _, t, la in rows[:60]])


def test_longer_phrases_start_before_the_first_cycle_ends(spark, rows, monkeypatch):
    seen = []
    real = co._step_counts

    def step(shard, at, *a):
        out = real(shard, at, *a)
        seen.append((at, {len(r.phrase.split()) for r in out.select("phrase").distinct().collect()}))
        return out
    monkeypatch.setattr(co, "_step_counts", step)
    co.phrase_counts(frame(spark, rows), 3, 3, 4)
    lengths = dict(seen)
    assert lengths[0] == {0, 1} and 2 in lengths[1] and 3 in lengths[2]  # interleaved
    assert 1 not in lengths[4] and max(lengths) <= 12  # single words take one cycle


def test_edges(spark):
    docs = edge_docs(spark)
    want = slow([(r.lang, r.text) for r in docs.select("lang", "text").collect()], min_count=4)
    assert multiset(co.collocations(docs, min_count=4).collect()) == want
    assert co.collocations(empty_docs(spark)).collect() == []


def test_exact_beyond_64_bits(spark):
    a = 3_000_000_019
    df = spark.createDataFrame([(a, a + 7, a + 11)], "a long, l long, r long")
    whole = lambda c: F.col(c).cast("decimal(16,0)")
    got = df.select((F.lit(1000000).cast("decimal(7,0)") * whole("a") * whole("a")).alias("top"), (whole("l") * whole("r")).alias("under"))
    assert got.select(F.expr("top div under")).first()[0] == 10 ** 6 * a * a // ((a + 7) * (a + 11))


def test_spread_join_deals_hot_keys(spark):
    big = spark.range(5000).select(F.expr("if(id % 3 = 0, 'hot', concat('k', id % 50))").alias("key"), F.col("id").alias("x"))
    small = big.select("key").distinct().withColumn("y", F.length("key"))
    got = spread_join(big, small, ["key"], limit=100)
    assert "_part" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.select("key", "x", "y").collect())) == sorted(map(tuple, big.join(small, "key").select("key", "x", "y").collect()))


def test_distinct_runs_by_one_number_or_by_steps():
    """Both ways of counting the runs of a chunk give the same words, ages and counts."""
    rng = np.random.default_rng(1)
    ids = rng.integers(1, 40, 5000)
    at = np.arange(4990)
    age = (ids[at] + ids[at + 1]) % 3
    for k in (2, 3):
        runs = Counter(tuple(ids[i:i + k].tolist()) for i in at)
        for base in (40, 10 ** 9):
            words, ages, n = co._distinct(ids, at, age, k, base, 3)
            rows = list(zip(*[w.tolist() for w in words]))
            assert rows == sorted(runs) and n.tolist() == [runs[r] for r in rows]
            assert ages.tolist() == [(r[0] + r[1]) % 3 for r in rows]
    assert all(len(c) == 0 for c in co._distinct(ids, at[:0], age[:0], 3, 40, 3)[0])
