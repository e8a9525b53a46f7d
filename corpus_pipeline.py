"""The training-corpus pipeline: quality classifier, line dedup, near-duplicate
removal, source mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last keep the columns of ``documents``.  ``run`` writes every stage's result as
Parquet into the shared folder that ``spark.checkpoint.dir`` names and reads it
again for the next, so a lost executor costs no more than the stage at hand.

Defined results of the stages: null and empty texts are scored like any text
without words, have no lines to lose, share fingerprint zero, size 0 and no
tokens; null ids and sources are values of their own; of rows equal in id and
text near-dedup keeps one; ties go to the least id; texts of any length are
taken whole; an empty table gives an empty one.  Extra columns of any name are
carried to the last stage, which returns its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, line_dedup, mixing, quality_gam, simhash
from quern.llm.common import read
from quern.plans.loops import scratch_folder
from quern.session import ship_package

# Classifier, component search and BPE have no SQL form.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    model = quality_gam.train(docs, read(spark, sf_dir, "labels"))
    return quality_gam.keep_good(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs, info=None)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, text): the ids of every document and their decoding."""
    import public_tokenizers
    return bpe.encode_and_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources", mix_sources),
    ("BPE encoding and decoding", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    ship_package(spark)
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"  # deleted when the application ends
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
