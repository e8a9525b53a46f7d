from collections import defaultdict

from llm_fixtures import WORD, docs_of, edge_docs, empty_docs
from pyspark.sql import functions as F

from quern.llm import mixing
from quern.llm.ranking import ranked


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    per = defaultdict(int)
    for s, n in sizes:
        per[s] += n
    order = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(per.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > cap * per[s]]
        if not over:
            target.update({s: level * w[s] for s in open_})
            break
        for s in over:
            target[s] = cap * per[s]
            left -= target[s]
            open_.discard(s)
    return per, target


def test_targets_and_taken_words(spark):
    for docs in (edge_docs(spark), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = mixing.mix(docs).collect()
        texts = [(r.source, len(WORD.findall(r.text or ""))) for r in docs.select("source", "text").collect()]
        per, target = slow_targets(texts)
        assert sorted((r.doc_id or -1, r.source or "", r.size) for r in rows) == sorted(
            (r.doc_id or -1, r.source or "", len(WORD.findall(r.text or ""))) for r in docs.select("doc_id", "source", "text").collect())
        taken, biggest = defaultdict(int), defaultdict(int)
        for r in rows:
            assert r.source_size == per[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
            assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
            taken[r.source] += r.taken
            biggest[r.source] = max(biggest[r.source], r.size)
        for s in per:
            assert abs(taken[s] - target[s]) <= biggest[s] + 1e-3 * target[s], s
        again = sorted(map(repr, mixing.mix(docs.repartition(7)).collect()))
        assert again == sorted(map(repr, rows))


def test_mixed_documents_are_the_copies(spark):
    docs = edge_docs(spark)
    want = sorted((r.doc_id or -1, r.source or "", r.copies) for r in mixing.mix(docs).groupBy("doc_id", "source").agg(
        F.sum("copies").alias("copies")).where("copies > 0").collect())
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id or -1, r.source or "", r["count"]) for r in out.groupBy("doc_id", "source").count().collect())
    assert got == want
    assert mixing.mix(empty_docs(spark)).collect() == [] and mixing.mixed_documents(empty_docs(spark)).collect() == []
    blank = docs_of(spark, ["", None])
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_ranks_of_a_hot_key_with_ties(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"),
                                  (F.col("id") % 4).alias("v"), "id")
    rows = ranked(df, ["k"], [F.col("v"), F.col("id")], "r").collect()
    by = defaultdict(list)
    for r in rows:
        by[r.k].append((r.v, r.id, r.r))
    assert len(rows) == 5000
    for v in by.values():
        assert [x[2] for x in sorted(v)] == list(range(1, len(v) + 1))
