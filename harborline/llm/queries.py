"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import (chat, collocations, decontaminate, language_id, licenses, near_join, packing, prefix_trie,
                            quality_model, quality_rules, secrets, token_files, toxicity)
from harborline.llm.common import table
from harborline.session import staging_path


def fold(folds: int, held: int) -> Column:
    """Whether crc32(doc_id as text) leaves this remainder."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(4, 2))
    return scored.select("doc_id", fold(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_components(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), literal=True,
                                      least_run=decontaminate.LEAST_RUN)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fold(4, 2))
    return scored.select("doc_id", fold(4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def document_path() -> Column:
    """Where a document would lie: source/language/id."""
    return F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(document_path().alias("path"), "text")
    return licenses.scan(files).withColumn("doc_id", F.element_at(F.split("path", "/"), -1).cast("long"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), fold(3, 1))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.digests(spark, path)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in [
    op1_quality_classifier, op2_ngram_jaccard_join, op3_packing, op4_decontamination, op5_toxicity, op6_license_scans,
    op7_language_id, op8_secret_scans, op9_chat_formatting, op10_quality_rules, op11_prefix_trie, op12_token_files, op13_collocations]}
