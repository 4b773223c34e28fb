"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybrook.llm import bpe, exact_dedup, mixing, simhash, toxicity
from tallybrook.llm.common import materialise
from tallybrook.llm.queries import vocabulary_path


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; fitted on the labelled rows of the folder's documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(spark, docs, toxicity.fit_labels(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels))


def _exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id."""
    return exact_dedup.drop_exact_copies(spark, docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the row with the smallest doc_id."""
    return simhash.drop_near_copies(spark, docs)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(spark, docs)


def _bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of the ids and of the text they decode to, a row for each document and repeat."""
    return bpe.digests(bpe.encode_decode(spark, docs, vocabulary_path()))


STAGES = [("toxicity", _toxicity), ("exact_dedup", _exact_dedup), ("simhash_near_dedup", _near_dedup), ("mixing", _mixing), ("bpe", _bpe)]

#: Learned scores, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
