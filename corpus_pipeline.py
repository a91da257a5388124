"""The corpus pipeline: from raw documents to token digests of the training mix.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of ``documents``. ``run`` writes each
stage's result as Parquet under the shared checkpoint folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isobar.llm import bpe, line_dedup, mixing, ngram_join, toxicity
from isobar.llm.common import table
from isobar.llm.queries import vocabulary_path
from isobar.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of several lines that occur earlier are cut from the texts. Copies of whole documents
    stay whole for the next stage, which keeps one of each group."""
    return line_dedup.dedup_lines(docs, keep_copies=True)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group stays."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out so that the sources meet their target weights."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document of the mix."""
    return bpe.bpe_digest(docs, vocabulary_path())


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_chunks),
          ("ngram_jaccard_join", keep_one_of_near_copies), ("mixing", mix), ("bpe", tokenize)]

# Learned scores, hashes and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
