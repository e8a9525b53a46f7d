import hashlib

import pytest
from llm_fixtures import WORD, docs_of, edge_docs, empty_docs
from pyspark.sql import functions as F

from quern.llm import sketch


def spark_hashes(spark, values, cast):
    uniq = sorted(set(values))
    if not uniq:
        return {}
    df = spark.createDataFrame([(v,) for v in uniq], f"v {cast}")
    return {tuple(r.v) if isinstance(r.v, list) else r.v: r.h for r in df.select("v", F.xxhash64("v").alias("h")).collect()}


def slow_sketches(spark, texts, scale):
    toks = [WORD.findall(t) for t in texts]
    h = spark_hashes(spark, [w for t in toks for w in t], "string")
    grams = [[tuple(h[w] for w in t[i:i + 5]) for i in range(len(t) - 4)] or ([tuple(h[w] for w in t)] if t else []) for t in toks]
    full = [g for gs in grams for g in gs]
    out = {}
    for n in {len(g) for g in full}:  # fixed arity equals hashing the columns one after another
        part = sorted({g for g in full if len(g) == n})
        df = spark.createDataFrame(part, ", ".join(f"c{i} long" for i in range(n)))
        out.update({tuple(r)[:-1]: r[-1] for r in df.select("*", F.xxhash64(*df.columns)).collect()})
    res = []
    for gs in grams:
        hs = {out[g] for g in gs}
        low = sorted(x for x in hs if x < sketch.threshold(scale))
        res.append(low or ([min(hs)] if hs else []))
    return res


def jaccard(a, b):
    return 1.0 if not a and not b else len(set(a) & set(b)) / len(set(a) | set(b))


def test_pairs_match_brute_force(spark):
    docs = edge_docs(spark).where("doc_id is not null and n_chars is null or n_chars < 100000").where("doc_id is not null")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()))
    nxt = [rows[(i + 1) % len(rows)][1] for i in range(len(rows))]
    edited = [t[: len(t) - len(t) // 4] + x[: len(t) // 4] for (_, t), x in zip(rows, nxt)]
    own, ed, nx = (slow_sketches(spark, t, 16) for t in ([t for _, t in rows], edited, nxt))
    hexes = lambda s: "".join(f"{x & (2**64 - 1):016x}" for x in s)
    want = sorted((d, len(t), hashlib.sha256(e.encode()).hexdigest(), hexes(a), hexes(b), jaccard(a, b), jaccard(a, c))
                  for (d, t), e, a, b, c in zip(rows, edited, own, ed, nx))
    got = sorted(tuple(r) for r in sketch.fingerprint_pairs(docs).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:])


def test_order_ends_and_ids_far_apart(spark):
    docs = docs_of(spark, ["aaaa bbbb", "cccc dddd", "eeee"]).withColumn("doc_id", F.col("doc_id") * 10_000_000_000)
    rows = {r.doc_id: r.next.text for r in sketch.next_documents(docs, F.lit(1)).collect()}
    assert rows == {0: "cccc dddd", 10_000_000_000: "eeee", 20_000_000_000: "aaaa bbbb"}
    one = docs_of(spark, ["abcdefgh"])
    r = sketch.fingerprint_pairs(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0
    assert sketch.fingerprint_pairs(empty_docs(spark)).collect() == []
    nulls = edge_docs(spark)
    assert sketch.fingerprint_pairs(nulls).count() == nulls.count()


def test_merge_is_the_sketch_of_both(spark):
    texts = [" ".join(f"t{i * k % 997}" for i in range(400)) for k in (1, 3)]
    df = docs_of(spark, texts).agg(F.min_by("text", "doc_id").alias("a"), F.max_by("text", "doc_id").alias("b"))
    hs = {k: set(df.select(sketch.sketch(F.col(k), 1)).first()[0]) for k in "ab"}
    row = df.select(sketch.merge(sketch.sketch(F.col("a")), sketch.sketch(F.col("b"))).alias("m")).first()
    assert row.m == sorted(x for x in hs["a"] | hs["b"] if x < sketch.threshold(16))
    part = df.select(sketch.containment(sketch.sketch(F.expr("substr(a, 1, 1200)")), sketch.sketch(F.col("a"))).alias("c")).first()
    assert part.c > 0.9


def test_containment_where_a_sketch_does_not_tell(spark):
    low, high, higher = -(1 << 63) + 5, 7, 9  # below and above the threshold
    cases = [([high], [low], None), ([low], [high], 0.0), ([high], [high], 1.0), ([high], [higher], 0.0), ([higher], [high], None),
             ([], [high], 1.0), ([low], [], 0.0), ([low, low + 1], [low], 0.5)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a array<long>, b array<long>")
    got = {r.i: r.c for r in df.select("i", sketch.containment(F.col("a"), F.col("b")).alias("c")).collect()}
    assert [got[i] for i in range(len(cases))] == [c for _, _, c in cases]


def test_query_is_near_the_exact_jaccard(spark, tmp_path):
    """The query's likeness against the Jaccard of the shingles themselves, on short and long texts."""
    import random

    from quern.llm.queries import QUERIES
    rng = random.Random(11)
    sizes = [20, 40, 80, 150, 400, 2000]
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(sizes[i % 6])) for i in range(600)]
    docs_of(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))

    def grams(t):
        w = WORD.findall(t)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    got = {r.doc_id: r for r in QUERIES["op7_scaled_sketch"](spark, str(tmp_path)).collect()}
    errors, zeros = {n: [] for n in sizes}, 0
    for i, t in enumerate(texts):
        edited = t[: len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][: len(t) // 4]
        true = jaccard(grams(t), grams(edited))
        errors[sizes[i % 6]].append(abs(got[i].near_edited - true))
        zeros += true >= 0.5 and got[i].near_edited == 0
    mean = {n: sum(e) / len(e) for n, e in errors.items()}
    assert zeros == 0 and max(mean[n] for n in sizes[:3]) < 0.12 and max(mean[n] for n in sizes[3:]) < 0.05, (zeros, mean)
