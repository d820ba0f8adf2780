"""The corpus pipeline: documents in, packed sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import decontaminate, near_join, packing, quality_model, secrets
from harborline.llm.common import table, written
from harborline.llm.queries import fold


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"), fold(4, 2))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_join.one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontamination", decontamination),
          ("secrets", secret_scan), ("packing", pack)]
ORACLE_SQL = None  # no stage but the secret scan can be said in SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
