"""From raw documents to a token stream, in stages that are each written and read again.

``run(spark, sf_dir)`` applies the stages to ``documents``: documents scored toxic go, of equal
texts one stays, of each group of near-duplicates one stays, the sources are mixed to their target
weights, and what is left is encoded.  Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.llm import exact_dedup, jaccard_join, mixing, sentencepiece, toxicity
from tempora.llm.common import scratch, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from ``labels`` and the documents at hand."""
    return toxicity.accepted(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    index = exact_dedup.DigestIndex.create(spark)
    try:
        return exact_dedup.deduplicated(docs, index)  # the digests that stay are written by then
    finally:
        index.drop()


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more that with the smallest doc_id stays."""
    return jaccard_join.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, none to two times."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens`` of every document, repeats included."""
    return sentencepiece.encode(docs)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("mixing", mix),
    ("sentencepiece", tokens),
]

#: A trained model, a random join and a random mix have no SQL form; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark):
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), "pipeline", name, outer=name == STAGES[-2][0])
    return STAGES[-1][1](spark, docs, sf_dir)
