import random
import zlib

import numpy as np
from llm_fixtures import edge_docs, empty_docs
from pyspark.sql import functions as F

from quern.llm import quality_gam as g

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_split(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = g.score(docs, g.train(docs, labels))
    rows = out.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    test = [(truth[r.doc_id], r.score >= g.THRESHOLD) for r in rows if r.held_out and r.doc_id in truth]
    assert len(test) > 40 and sum(bool(y) == p for y, p in test) / len(test) >= 0.97


def test_held_out_labels_are_never_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(g.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda y: sorted(map(tuple, g.score(docs, g.train(docs, y)).collect()))
    assert score(labels) == score(turned)


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12, 60)] + [(1, None, 0), (2, 7, 0), (None, 1, 0), (999, 1, 0), (13, 0, 1)],
                                   "doc_id long, quality long, toxic long")
    model = g.train(docs, labels)
    assert g.score(docs, model).count() == docs.count()
    assert g.keep_good(docs, model, 0.0).count() == docs.count() and g.keep_good(docs, model, 0.0).columns == docs.columns
    assert g.score(empty_docs(spark), model).collect() == []
    none = g.train(docs, labels.where("quality > 100"))
    assert {r.score for r in g.score(docs, none).collect()} == {0.5}
    assert len(g.features(None)) == len(g.features("a b\nc")) == len(g.FEATURES)


def test_fit_learns_a_pair_that_no_single_feature_shows():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) == (x[:, 1] > 0.5)).astype(float)
    m = g.fit(x[:3000], y[:3000])
    assert (0, 1) in m.pairs and ((m.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9


def test_text_order_of_features_is_fixed():
    rng = random.Random(1)
    t = " ".join(rng.choice(["a", "B##", "c|", "Dd."]) for _ in range(900))
    assert g.features(t) == g.features(t) and all(np.isfinite(g.features(t)))
