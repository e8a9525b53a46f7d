"""Small tables for the tests of the llm operators."""
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def edge_docs(spark, extra=True):
    """Nulls in every column, empty and long texts, ties, repeated rows, and
    extra columns whose names clash with result columns."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["Éa", "ñu", "THE", "the", "#x#"]
    long_text = " ".join(rng.choice(vocab) for _ in range(30_000))
    base = " ".join(rng.choice(vocab) for _ in range(120))
    near = base.replace(base.split()[60], "changed", 1)
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"), (4, "", "en", None), (5, None, None, "b"),
            (6, " \n\t ", "en", "a"), (7, "one two", "de", "c"), (7, "one two", "de", "c"), (None, base, "en", "a"),
            (None, None, None, None), (8, long_text, "en", "a"), (9, "x\ny\nx\n\n y", "fr", "c"),
            (10, "a b c d e f a b c d e\x85 z", "en", "d"), (11, "A\x0bB\x0cC\rD", "en", "")]
    for i in range(12, 60):
        rows.append((i, "\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 6))),
                     rng.choice(["en", "de"]), rng.choice(["a", "a", "b", "c"])))
    data = [(i, t, la, so, None if t is None else len(t)) for i, t, la, so in rows]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({"size": F.lit("clash"), "kept": F.lit(1.5), "score": F.lit("s"), "fp": F.lit(None).cast("int"),
                             "words": F.array(F.lit(1)), "h": F.lit("h")})
    return df


def empty_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", None if t is None else len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def multiset(rows):
    return sorted((tuple(r) for r in rows), key=repr)
