"""A corpus, end to end: five stages over ``documents``, each reading what the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from feedertrace.llm import classifier, decontaminate, line_dedup, packing, simhash
from feedertrace.session import read_table, shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of the input's documents."""
    weights = classifier.fit(docs, read_table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return classifier.keep_good(docs, weights, limit=0.3)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted from the texts; n_chars follows."""
    found = line_dedup.dedup_lines(docs, min_words=8)
    return found.selectExpr(*("CAST(CASE WHEN n_deleted > 0 THEN length(text) ELSE n_chars END AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five words, similarity 0.8 or more."""
    return simhash.one_of_each(docs, shingle=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, placed in training sequences."""
    return packing.pack_documents(docs, seq_len=1024, eos_id=2)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
    return docs


#: Training, prefix doubling and packing are not for SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None
