"""The corpus pipeline: documents are filtered, deduplicated, mixed and encoded, stage by stage.

Each stage is called with what the one before it wrote, and all but the last return the columns of
``documents``.  No SQL gives the rows of ``run``: the classifier is trained and the encoder's merges
are not relational, so the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palate.llm import bpe, mixing, quality_classifier, quality_rules, simhash
from palate.session import settle


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_likely_by(docs, labels)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(docs, bpe.vocabulary()))


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
