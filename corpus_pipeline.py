"""A corpus pipeline of five operators: toxicity, exact and near duplicates, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read back as the next stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import bpe, exact_dedup, mixing, simhash, toxicity
from quire.llm.common import load, workspace, written
from quire.llm.queries import vocabulary


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document of least id."""
    return exact_dedup.drop_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group, the document of least id."""
    return simhash.drop_near_copies(docs, shingle_words=3, max_bits=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row per document and epoch that reads it."""
    return mixing.mixed_documents(docs, weights=(5.0, 2.0, 1.0), share=1.5, most=2)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes."""
    return bpe.encode_documents(docs, vocabulary(), keep=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", bpe_stage),
]

# The toxicity stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        # what a stage keeps on the way is deleted once its result is stored
        with workspace(spark):
            docs = written(stage(spark, docs, sf_dir), outside=True)
    return docs
