"""The corpus pipeline: five stages, each written as a table and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import jaccard_join, packing, quality_classifier, secret_scan, toxicity
from tablecheck.llm.common import table
from tablecheck.llm.queries import vocabulary
from tablecheck.session import pin


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on this stage's input, rejects go."""
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on this stage's input, rejects go."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, Jaccard similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the documents stay."""
    return secret_scan.redact(docs, secret_scan.Ledger(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; the pieces with a checksum of their ids."""
    pieces = packing.pack(docs, vocabulary("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("near duplicates", no_near_duplicates),
    ("secret scans", no_secrets),
    ("packing", packed),
]
#: The classifiers and the tokenizer can't be expressed in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
