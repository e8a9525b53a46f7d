import importlib

import pytest
from llm_fixtures import docs_of
from pyspark.sql import functions as F

from quern.llm import bpe, line_dedup, mixing, quality_gam, simhash

pytest.importorskip("public_tokenizers")
corpus_pipeline = importlib.import_module("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages_by_name_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "SimHash near-dedup", "mixing sources",
                                                      "BPE encoding and decoding"]


def test_each_stage_acts_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
    cols = docs.columns
    assert all(s.columns == cols and [t for _, t in s.dtypes] == [t for _, t in docs.dtypes] for s in seen[:-1])
    rows = [{r.doc_id: r for r in s.collect()} for s in seen]
    counts = [s.count() for s in seen]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    model = quality_gam.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality_gam.score(docs, model).where("score >= 0.3").collect()}
    assert set(rows[1]) == good and all(rows[1][d].text == rows[0][d].text for d in good)
    assert sum(labels.get(d) == 1 for d in rows[0]) == sum(labels.get(d) == 1 for d in rows[1])
    assert counts[2] == counts[1] and all(r.n_chars == len(r.text) for r in rows[2].values())
    cleaned = {r.doc_id: r.text for r in line_dedup.dedup_lines(seen[1]).collect()}
    assert cleaned == {d: r.text for d, r in rows[2].items()}
    comps = simhash.components(seen[2]).collect()
    assert sorted(rows[3]) == sorted({r.component_id for r in comps}) and counts[3] == len(rows[3])
    want = {r.doc_id: r.copies for r in mixing.mix(seen[3]).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in seen[4].groupBy("doc_id").count().collect()}
    assert got == want and all(rows[4][d] == rows[3][d] for d in got)
    import public_tokenizers
    own = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    assert counts[5] == counts[4]
    for r in seen[5].collect():
        ids = own.encode(rows[4][r.doc_id].text).tolist()
        assert r.ids == ids and r.n_tokens == len(ids) and r.text == own.decode(ids)
    again = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.n_tokens) for r in df.collect())
    assert key(again) == key(seen[5])


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_stages_keep_extra_columns_and_nulls(spark):
    text = "The quiet river ran on past the old mill and nobody was there to see it go, as always."
    docs = docs_of(spark, [text, None, "", text]).withColumns({"ids": F.lit("x"), "score": F.lit(1)})
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.collect()
