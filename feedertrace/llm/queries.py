"""The thin queries over the driver's tables, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedertrace.llm import classifier, decontaminate, licenses, line_dedup, lm, packing, pii, quality_rules, simhash, url_rules
from feedertrace.llm.text import fold
from feedertrace.session import read_table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), seq_len=1024, eos_id=2)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read_table(spark, sf_dir, "documents"), folds=10, held_out=0)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), min_words=8).select("doc_id", "n_lines", "n_deleted", "text")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    weights = classifier.fit(docs, read_table(spark, sf_dir, "labels"), folds=5, held_out=0)
    found = classifier.score(docs, weights, limit=0.3)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pii": op2_pii,
    "op3_url_rules": op3_url_rules,
    "op4_simhash": op4_simhash,
    "op5_license_scan": op5_license_scan,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_rules": op7_quality_rules,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
}
ORACLES: dict[str, str] = {"op5_license_scan": licenses.sql(), "op7_quality_rules": quality_rules.SQL}
