"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it has left, and returns the columns of
documents; the last returns sequences of token ids with the bounds of the documents in them. Between stages the
rows are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftlane.llm import decontaminate, packing, quality, secrets, simhash
from siftlane.llm.common import shared_path, vocabulary
from siftlane.session import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model trained on trusted ones accepts."""
    judged = quality.train(docs, table(spark, sf_dir, "labels")).judge(docs)
    return judged.where("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: Jaccard similarity of five-word shingles 0.8 or more."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_contaminated(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redact(docs, secrets.train(secrets.labelled_samples(docs)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 512, 1024 or 2048 tokens with the ids of all documents."""
    return packing.pack_tokens(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]

#: SQL expresses neither the language model nor the fingerprints; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, all stages applied to documents."""
    docs, path = table(spark, sf_dir, "documents"), shared_path(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{i}")
        docs = spark.read.parquet(f"{path}/{i}")
    return docs
